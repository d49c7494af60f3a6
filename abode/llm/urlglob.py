"""URL filter: a bit-parallel automaton that runs all glob rules at once.

A rule is a glob over the canonical URL (``.`` + host + path): ``*`` stands for
any characters but ``/``, ``**`` for any characters, a backslash makes the next
character plain. Rules are packed one after another into 64-bit words, one bit
a position. For each character, every state word is shifted, masked by the
character's word and joined with the positions whose star accepts it; a carry
takes a rule across word borders. Tasks run the automaton over many URLs at a
time, one character position after another, so each step is a few numpy
operations on a matrix of (URLs, words).

The masks grow with the rules' total length only; rule lists are a parameter of
the job, and reach the tasks with the function.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from abode.llm.batches import map_batches

ALLOW, BLOCK = "allow", "block"
CHUNK = 1024


@dataclass(frozen=True)
class Rule:
    """``glob`` over ``.host/path``; ``name`` is reported; longer names win."""

    verdict: str
    glob: str
    name: str


def host_rule(verdict: str, name: str) -> Rule:
    """Rule for a host, its subdomains and all paths that start as ``name`` says: ``net/`` or ``a.net/x/``."""
    host, slash, path = name.partition("/")
    plain = "".join("\\" + c if c in "*\\" else c for c in host.lower() + slash + path)
    return Rule(verdict, f"*.{plain}**", name)


def canonical(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path: what stands after the first ``://`` up to ``/?#``, then up to ``?#``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    cut = min(ends, default=len(rest))
    path = rest[cut:].split("?", 1)[0].split("#", 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path


class Automaton:
    """Masks of a rule list; ``run`` gives each URL's best rule, or -1."""

    def __init__(self, rules: list[Rule]):
        self.rules = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict))
        plain: dict[str, list[int]] = {}
        star, wide, start, accept = [], [], [], []
        at = 0
        for rule in self.rules:
            start.append(at)  # this bit stands for "nothing read yet"
            at += 1
            glob, i = rule.glob, 0
            while i < len(glob):
                if glob.startswith("**", i):
                    wide.append(at - 1)
                    i += 2
                    continue
                if glob[i] == "*":
                    star.append(at - 1)
                    i += 1
                    continue
                if glob[i] == "\\" and i + 1 < len(glob):
                    i += 1
                plain.setdefault(glob[i], []).append(at)
                at += 1
                i += 1
            accept.append(at - 1)
        self.words = max(1, -(-at // 64))
        self.symbols = np.array(sorted(ord(c) for c in plain), dtype=np.uint32)
        self.step = np.zeros((len(plain) + 1, self.words), dtype=np.uint64)  # the last row: any other character
        self.stay = np.zeros_like(self.step)
        self.start = self._bits(start)
        self.accept = accept
        for k, code in enumerate(self.symbols):
            self.step[k] = self._bits(plain[chr(code)])
        self.stay[:] = self._bits(wide) | self._bits(star)
        slash = np.searchsorted(self.symbols, ord("/"))
        if slash < len(self.symbols) and self.symbols[slash] == ord("/"):
            self.stay[slash] = self._bits(wide)
        self.slash = None if slash < len(self.symbols) and self.symbols[slash] == ord("/") else self._bits(wide)

    def _bits(self, positions: list[int]) -> np.ndarray:
        out = np.zeros(self.words, dtype=np.uint64)
        for p in positions:
            out[p // 64] |= np.uint64(1) << np.uint64(p % 64)
        return out

    def run(self, urls: list[str]) -> np.ndarray:
        best = np.full(len(urls), -1, dtype=np.int64)
        order = sorted(range(len(urls)), key=lambda i: -len(urls[i]))
        for at in range(0, len(order), CHUNK):
            own = order[at : at + CHUNK]
            best[own] = self._run([urls[i] for i in own])
        return best

    def _run(self, urls: list[str]) -> np.ndarray:
        """``urls`` by falling length: the first ``live`` ones still have a character at each position."""
        lengths = np.array([len(u) for u in urls])
        state = np.tile(self.start, (len(urls), 1))
        text = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        offset = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        found = np.searchsorted(self.symbols, text)
        known = found < len(self.symbols)
        known[known] = self.symbols[found[known]] == text[known]
        symbol = np.where(known, found, len(self.symbols))
        for t in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-lengths, -t, side="left"))
            c = symbol[offset[:live] + t]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            stay = self.stay[c]
            if self.slash is not None:
                stay[text[offset[:live] + t] == ord("/")] = self.slash
            state[:live] = (moved & self.step[c]) | (now & stay)
        best = np.full(len(urls), -1, dtype=np.int64)
        for k in range(len(self.rules) - 1, -1, -1):
            p = self.accept[k]
            best[(state[:, p // 64] >> np.uint64(p % 64)) & np.uint64(1) == 1] = k
        return best


def filter_urls(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """One row per input row: ``<id_col>, host, path, rule, verdict``.

    The rule with the longest name among those that match decides; of equally
    long ones the first in string order. Without a match ``rule`` is null and
    the verdict ``default``. A null URL, or one without ``://``, has an empty
    host and path and is matched as the text ``.``. Repeated rows each get
    their own; an empty table gives no rows.
    """
    schema = pa.schema(
        [(id_col, to_arrow_type(df.schema[id_col].dataType)), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())]
    )
    machine = Automaton(rules)

    def work(batch: pa.RecordBatch) -> dict:
        parts = [canonical(u) for u in batch.column(1).to_pylist()]
        best = machine.run([f".{h}{p}" for h, p in parts])
        hits = [machine.rules[k] if k >= 0 else None for k in best]
        return {
            id_col: batch.column(0),
            "host": [h for h, _ in parts],
            "path": [p for _, p in parts],
            "rule": [r and r.name for r in hits],
            "verdict": [r.verdict if r else default for r in hits],
        }

    return map_batches(df.select(id_col, url_col), work, schema)
