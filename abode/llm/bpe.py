"""Byte-level BPE, with tree concatenation for long texts.

Runs without a blank of up to ``LEAF`` characters go to the merge loop as they
are; a longer run is halved, the halves are encoded on their own, and the two
token lists are joined: a window of tokens around the
join is encoded again and grows until its first token is the left side's and its
last token the right side's. A token list is a valid encoding if every two
neighbours are, so agreement on one token at each end makes the whole exact.

Texts over ``LONG`` characters are cut into segments that different tasks
encode; rounds of pairwise joins up a tree give one list per distinct text, so
one huge document doesn't hold up a task and copies are encoded once.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abode.llm.batches import map_batches
from abode.plans.materialize import materialize

# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE = re.compile(r"\s*\S+|\s+", re.ASCII)  # a cut before a blank, after anything else, never changes the tokens
ODD_BLANK = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
LEAF, WINDOW = 1024, 4
LONG, SEGMENT, NEAR = 32768, 16384, 512


class Coder:
    """Encodes and decodes with the vocabulary of a tokenizer file; one for each worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
        plain = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(plain[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in plain for c in token)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {token: i for token, i in ranks.items() if i not in self.special.values()}
        self.bytes = {i: token for token, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(names)})") if names else None
        self.plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.marks.split(text) if self.marks else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                self._part(part, out)
        return out

    def _part(self, text: str, out: list[int]) -> None:
        if len(text) <= LEAF or max(map(len, text.split()), default=0) <= LEAF:
            out += self.plain(text)
        elif ODD_BLANK.search(text):
            out += self.tree(text)
        else:
            near: list[str] = []
            for piece in PIECE.findall(text):
                if len(piece) <= LEAF:
                    near.append(piece)
                    continue
                out += self.plain("".join(near))
                out += self.tree(piece)
                near.clear()
            out += self.plain("".join(near))

    def tree(self, text: str) -> list[int]:
        """Encode the halves of a text without special tokens, then join them."""
        if len(text) <= LEAF:
            return self.plain(text)
        half = len(text) // 2
        return self.join(self.tree(text[:half]), self.tree(text[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the two texts as one, from the tokens of each."""
        w = WINDOW
        while True:
            a, b = max(0, len(left) - w), min(len(right), w)
            w *= 2
            try:
                text = b"".join(map(self.bytes.__getitem__, left[a:] + right[:b])).decode()
            except UnicodeDecodeError:  # the window begins or ends within a character
                continue
            mid = self._window(text)
            whole_left, whole_right = a == 0, b == len(right)
            if (whole_left or mid[:1] == left[a : a + 1]) and (
                whole_right or (mid[-1:] == right[b - 1 : b] and not text[-1:].isspace())
            ):
                return left[:a] + mid + right[b:]

    def _window(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.marks.split(text) if self.marks else [text]:
            out += [self.special[part]] if part in self.special else self.plain(part)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def segments(self, text: str) -> list[str]:
        """Cuts about every ``SEGMENT`` characters, at a blank if one is near, never within a special token."""
        cuts = [0]
        while len(text) - cuts[-1] > SEGMENT * 3 // 2:
            at = cuts[-1] + SEGMENT
            blank = text.rfind(" ", at - NEAR, at)
            at = blank if blank > cuts[-1] else at
            for token in self.special:
                hit = text.find(token, max(0, at - len(token) + 1), at + len(token) - 1)
                if 0 <= hit < at:
                    at = hit if hit > cuts[-1] else hit + len(token)
            cuts.append(at)
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


IDS = pa.list_(pa.int32())


def packed(ids: list[int]) -> np.ndarray:
    """Four bytes an id, so that a slice of rows doesn't hold a Python object for each."""
    return np.array(ids, dtype=np.int32)


def encode_texts(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG, digest: bool = False
) -> DataFrame:
    """One row per input row: ``<id_col>, ids``, the token ids of the whole text; with ``digest``, also ``text_sha256``.

    ``tokenizer`` is the path of a byte-level BPE file that every executor can
    read. Special tokens spelled out in a text get their ids. A null or empty
    text has no tokens; repeated rows each get their own; an empty table gives
    no rows; other columns aren't read.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    out = pa.schema([("_id", to_arrow_type(df.schema[id_col].dataType)), ("ids", IDS)])
    if digest:
        rows = rows.withColumn("text_sha256", F.sha2("_text", 256))
        out = out.append(pa.field("text_sha256", pa.string()))
    own = [f.name for f in out]

    def whole(batch: pa.RecordBatch) -> dict:
        encode = coder(tokenizer).encode
        ids = [packed(encode(t.as_py())) for t in batch.column(1)]
        return {"_id": batch.column(0), "ids": ids} | ({"text_sha256": batch.column(2)} if digest else {})

    short = map_batches(rows.where(F.length("_text") <= long), whole, out)

    texts = rows.where(F.length("_text") > long).withColumn("_key", F.sha2("_text", 256))
    lists = _encode_long(texts.select("_key", "_text"), tokenizer)
    joined = texts.drop("_text").join(lists, "_key").select(*own)
    return short.unionByName(joined).withColumnRenamed("_id", id_col)


def _encode_long(texts: DataFrame, tokenizer: str) -> DataFrame:
    """``_key, ids`` of each distinct key's text."""
    seg = pa.schema([("_key", pa.string()), ("_seg", pa.int64()), ("_part", pa.string())])

    def cut(batch: pa.RecordBatch) -> dict:
        parts = [(k, coder(tokenizer).segments(t)) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        flat = [(k, i, p) for k, ps in parts for i, p in enumerate(ps)]
        return {"_key": [x[0] for x in flat], "_seg": [x[1] for x in flat], "_part": [x[2] for x in flat]}

    leaf = pa.schema([("_key", pa.string()), ("_seg", pa.int64()), ("ids", IDS)])

    def encode(batch: pa.RecordBatch) -> dict:
        one = coder(tokenizer).encode
        return {"_key": batch.column(0), "_seg": batch.column(1), "ids": [packed(one(t.as_py())) for t in batch.column(2)]}

    def pair(batch: pa.RecordBatch) -> dict:
        join, ids = coder(tokenizer).join, []
        for parts in batch.column(2):
            lists = [x.as_py() for x in parts.values.field("ids")]
            ids.append(packed(lists[0] if len(lists) == 1 else join(*lists)))
        return {"_key": batch.column(0), "_seg": batch.column(1), "ids": ids}

    parts = map_batches(texts, cut, seg).dropDuplicates(["_key", "_seg"])  # copies are encoded once
    level = materialize(map_batches(parts, encode, leaf))
    last = level.agg(F.max("_seg")).collect()[0][0] or 0
    while last > 0:
        pairs = level.groupBy("_key", F.expr("_seg div 2").alias("_seg")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("_seg").alias("s"), "ids"))).alias("_parts")
        )
        level = map_batches(pairs, pair, leaf)
        last //= 2
    return level.select("_key", "ids")


def decode_ids(df: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its token lists; special tokens come out as they are spelled, null lists as null."""

    @F.pandas_udf("string")
    def text(lists):
        return lists.map(lambda ids: coder(tokenizer).decode(ids.tolist()), na_action="ignore")

    return df.withColumn(out_col, text(F.col(ids_col)))


def token_report(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """From ``<id_col>, ids``: the number of tokens, and digests of the ids and of the decoded text.

    If the rows carry ``text_sha256``, also ``round_trip``: whether the row's own text is what the ids decode to.
    """
    schema = pa.schema(
        [(id_col, to_arrow_type(encoded.schema[id_col].dataType)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    columns = [id_col, "ids"]
    if "text_sha256" in encoded.columns:
        schema = schema.append(pa.field("round_trip", pa.bool_()))
        columns.append("text_sha256")

    def work(batch: pa.RecordBatch) -> dict:
        lists, decode = [x.values.to_numpy() for x in batch.column(1)], coder(tokenizer).decode
        out = {
            id_col: batch.column(0),
            "n_tokens": [len(x) for x in lists],
            "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists],
            "decoded_sha256": [hashlib.sha256(decode(x.tolist()).encode()).hexdigest() for x in lists],
        }
        if len(columns) > 2:
            out["round_trip"] = [a == b for a, b in zip(out["decoded_sha256"], batch.column(2).to_pylist())]
        return out

    return map_batches(encoded.select(*columns), work, schema)
