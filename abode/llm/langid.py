"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 in ``DIM`` dimensions. A letter's
place in an n-gram is bound by rotating its vector, the n-gram's vector is the
product of the rotated letters, and a text's vector is the sum (bundle) over its
n-grams. A language's prototype bundles the training texts of that language; a
text gets the language whose prototype has the largest cosine with its vector.

Letter vectors come from a seed and the letter's number, so tasks rebuild those
they meet; they are all a task needs besides the prototypes. Training adds up integer vectors inside tasks and
then one row per language, task and dimension block, so neither a common
language nor a long text gathers anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abode.llm.batches import SLICE_ROWS, map_batches

DIM, GRAM, SEED = 1024, 3, 20240229
UNKNOWN = "und"
BLOCK = 512  # n-grams whose vectors are made at a time
MANY, TABLE = 8000, 1 << 18  # characters from which counting by table is faster than sorting, and the largest such table
CELLS = 1 << 23  # counts of texts x n-grams held at a time
FULL = 1 << 18  # distinct n-grams a language's counts hold before they are added up


def _lower(code: int) -> int:
    return ord(chr(code).lower()[0])


ALPHABET = [code for code in range(0x110000) if chr(code).isalpha()]
LATIN = range(97, 123)
#: Blank, a-z, and every other lower-cased letter by code point.
LETTERS = [0, *LATIN, *sorted({_lower(code) for code in ALPHABET}.difference(LATIN))]
SYMBOLS = len(LETTERS)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Symbol of each code point: 0 for what is no letter, 1-26 for a-z, an own number for each other letter."""
    number = {code: i for i, code in enumerate(LETTERS)}
    table = np.zeros(0x110000, dtype=np.int32)
    table[ALPHABET] = [number[_lower(code)] for code in ALPHABET]
    return table


class _Vectors:
    """Vectors of the symbols met so far: rows of one seeded table, of which only these are made."""

    def __init__(self) -> None:
        self.place = np.full(SYMBOLS, -1, dtype=np.int32)
        self.rows, self.size = np.empty((64, DIM), dtype=np.int8), 0

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        for symbol in np.unique(symbols[self.place[symbols] < 0]).tolist():
            if self.size == len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            bits = np.random.PCG64(SEED).advance(symbol * DIM // 8)  # one 64-bit draw makes eight entries
            self.rows[self.size] = np.random.Generator(bits).integers(0, 2, DIM, dtype=np.int8) * 2 - 1
            self.place[symbol] = self.size
            self.size += 1
        return self.rows[self.place[symbols]]


@lru_cache(maxsize=1)
def known_vectors() -> _Vectors:
    return _Vectors()


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a whole text and their counts; none if it has no letter.

    Runs of other characters count as one blank; the text's ends are blanks.
    """
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    if not codes.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = np.zeros(len(codes) + 2, dtype=np.int64)
    padded[1:-1] = codes
    blank = padded == 0
    padded = padded[~(blank & np.concatenate([[False], blank[:-1]]))]
    many = len(padded) - GRAM + 1
    if many >= MANY:
        own = np.flatnonzero(np.bincount(padded, minlength=SYMBOLS))
        if len(own) ** GRAM <= TABLE:  # numbered by the text's own letters
            number = np.zeros(SYMBOLS, dtype=np.int64)
            number[own] = np.arange(len(own))
            sums = np.bincount(_joined(number[padded], len(own)))
            found = np.flatnonzero(sums)
            codes = np.zeros(len(found), dtype=np.int64)
            for place in range(GRAM):
                codes = codes * SYMBOLS + own[found // len(own) ** (GRAM - 1 - place) % len(own)]
            return codes, sums[found]
    gram = _joined(padded, SYMBOLS)
    gram.sort()
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    return gram[first], np.diff(first, append=many)


def _joined(symbols: np.ndarray, size: int) -> np.ndarray:
    """Code of each n-gram of symbols under ``size``."""
    many = len(symbols) - GRAM + 1
    gram = symbols[:many].copy()
    for place in range(1, GRAM):
        gram *= size
        gram += symbols[place : many + place]
    return gram


def vectors(codes: np.ndarray) -> np.ndarray:
    """The n-grams' vectors, one a row."""
    own = known_vectors()
    out = own(codes % SYMBOLS)
    for place in range(GRAM - 2, -1, -1):
        codes = codes // SYMBOLS
        out *= np.roll(own(codes % SYMBOLS), GRAM - 1 - place, axis=1)
    return out


def bundles(texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The texts' vectors, one a row, from their n-gram codes and counts.

    Sums of whole numbers: exact in float32 up to 16 million n-grams a text,
    rounded beyond. Each n-gram's vector is made once for all texts, or for a
    part of them if they have too many n-grams between them.
    """
    known, column = np.unique(np.concatenate([c for c, _ in texts]), return_inverse=True)
    if len(texts) > 1 and len(texts) * len(known) > CELLS:
        half = len(texts) // 2
        return np.concatenate([bundles(texts[:half]), bundles(texts[half:])])
    row = np.repeat(np.arange(len(texts)), [len(c) for c, _ in texts])
    counts = np.zeros((len(texts), len(known)), dtype=np.float32)
    counts[row, column] = np.concatenate([n for _, n in texts])
    out = np.zeros((len(texts), DIM), dtype=np.float32)
    for at in range(0, len(known), BLOCK):
        out += counts[:, at : at + BLOCK] @ vectors(known[at : at + BLOCK]).astype(np.float32)
    return out.astype(np.float64)


class _Sum:
    """Vector of one language's texts: n-gram counts, added up whenever ``FULL`` distinct ones are held."""

    def __init__(self) -> None:
        self.vector = np.zeros(DIM, dtype=np.int64)
        self.codes, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((codes, counts))
        self.waiting += len(codes)
        if self.waiting > FULL:
            self._merge()
            if len(self.codes) > FULL:
                self.total()

    def _merge(self) -> None:
        codes = np.concatenate([self.codes, *(c for c, _ in self.parts)])
        counts = np.concatenate([self.counts, *(n for _, n in self.parts)])
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)])
        self.codes, self.counts = codes[first], np.add.reduceat(counts[order], first) if len(first) else counts
        self.parts, self.waiting = [], 0

    def total(self) -> np.ndarray:
        self._merge()
        for at in range(0, len(self.codes), BLOCK):
            self.vector += self.counts[at : at + BLOCK] @ vectors(self.codes[at : at + BLOCK]).astype(np.int64)
        self.codes, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        return self.vector


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each non-null language, from all rows of ``df``.

    A text counts by its n-grams, so n-gram counts are summed first and each
    distinct n-gram's vector is added once per task and language, or once for
    every ``FULL`` distinct ones where an alphabet has more.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, _Sum] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    codes, counts = grams(text)
                    if len(codes):
                        total.setdefault(lang, _Sum()).add(codes, counts)
        for lang, sums in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * DIM, "dim": np.arange(DIM, dtype=np.int32), "v": sums.total()})

    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    parts = rows.where("text is not null and lang is not null").mapInArrow(partial, "lang string, dim int, v long")
    out: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "dim").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r["lang"], np.zeros(DIM))[r["dim"]] = r["v"]
    return out


class Profiles:
    """Prototypes of unit length, in order of language."""

    def __init__(self, prototypes: dict[str, np.ndarray]):
        known = sorted(k for k, v in prototypes.items() if v.any())
        self.langs = known
        self.unit = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in known]).reshape(len(known), DIM)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [grams(t or "") for t in texts]
        known = [i for i, (codes, _) in enumerate(found) if len(codes)] if self.langs else []
        out = [(UNKNOWN, 0.0)] * len(texts)
        if known:
            sums = bundles([found[i] for i in known])
            length = np.maximum(np.linalg.norm(sums, axis=1), 1e-9)
            cosine = sums @ self.unit.T / length[:, None]
            for i, best, row in zip(known, cosine.argmax(axis=1), cosine):
                out[i] = self.langs[best], round(min(1.0, max(0.0, float(row[best]))), 6)
        return out


def identify(df: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>, lang_pred, score``; only the text decides.

    ``score`` is the best cosine, cut to 0..1; of equal cosines the first
    language in string order wins. A null text, or one without a letter, gets
    ``und`` and 0, and so does every text if no language was learned. Repeated
    rows each get their own; an empty table gives no rows.
    """
    schema = pa.schema([(id_col, to_arrow_type(df.schema[id_col].dataType)), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batch: pa.RecordBatch) -> dict:
        found = profiles.predict(batch.column(1).to_pylist())
        return {id_col: batch.column(0), "lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

    return map_batches(df.select(id_col, text_col), work, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: CRC-32 of its identifier as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows that aren't held out, predict all: ``<id_col>, held_out, lang_pred, score``."""
    profiles = Profiles(train(df.where(~held_out(id_col)), text_col, lang_col))
    found = identify(df, profiles, id_col, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")


def drop_unknown(df: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text has no language: null, or without a letter.

    Letters alone decide: any profile takes a text that has one, and without
    profiles such texts stay, too.
    """

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        parts = (texts.iloc[at : at + SLICE_ROWS].tolist() for at in range(0, len(texts), SLICE_ROWS))
        if not profiles.langs:
            return pd.Series([len(grams(t or "")[0]) > 0 for part in parts for t in part], dtype=bool)
        return pd.Series([lang != UNKNOWN for part in parts for lang, _ in profiles.predict(part)], dtype=bool)

    return df.where(known(F.col(text_col)))
