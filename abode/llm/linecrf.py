"""Document quality from a linear-chain conditional random field over lines.

A text is split into lines, and every line is labelled good or bad. What a line
looks like (``STATS``: shares of character classes, word lengths, repeats) is
cut at the training sample's quantiles into yes/no features; a line's score
weighs its own features and those of the lines before and after, and a 2 x 2 table weighs
neighbouring labels. Forward-backward sums give each line's probability of being good given
the whole text, and a document's quality is their mean, weighted by line length.

Training takes a bounded sample of labelled documents (``TRAIN_DOCS``), each line
with its document's label, and maximises the conditional likelihood. Scoring maps
over all rows and whole texts, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abode.llm.batches import map_batches

#: Labelled documents a model is fitted on at most, lines of one of them (longer ones are
#: not taken into the sample) and lines in all.
TRAIN_DOCS, DOC_LINES, TRAIN_LINES = 4000, 100, 60_000
#: Quantiles of the sample's lines at which a statistic is cut, dense at both ends, where odd lines stand out.
QUANTILES = (0.01, 0.03, 0.08, 0.2, 0.4, 0.6, 0.8, 0.92, 0.97, 0.99)
STEPS, RATE, RIDGE = 250, 0.08, 1.0
THRESHOLD = 0.3

STATS = [
    "characters", "letters", "digits", "capitals", "blanks", "punctuation", "symbols", "exclamation", "bars", "beyond_ascii",
    "words", "word_length", "longest_word", "distinct_words", "repeats_before", "sentence_end", "capital_start", "seen_before",
]
LETTER, CAPITAL, DIGIT, BLANK, MARK, SYMBOL, SHOUT, BAR, HIGH, OTHER = range(10)


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    for kind, members in (
        (LETTER, b"abcdefghijklmnopqrstuvwxyz"),
        (CAPITAL, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (DIGIT, b"0123456789"),
        (BLANK, b" \t\r\x0b\x0c"),
        (MARK, b".,;:?'\"()-"),
        (SYMBOL, b"#$%&*<>{}[]\\^~@=+_/`"),
        (SHOUT, b"!"),
        (BAR, b"|"),
    ):
        table[list(members)] = kind
    table[128:] = HIGH
    return table


CLASSES = _classes()


def line_stats(line: bytes, seen: bool) -> list[float]:
    """What a line looks like, in the order of ``STATS``."""
    count = np.bincount(CLASSES[np.frombuffer(line, dtype=np.uint8)], minlength=10).tolist()
    size = max(1, len(line))
    letters = count[LETTER] + count[CAPITAL] + count[HIGH]
    words = line.split()
    many = max(1, len(words))
    bare = line.rstrip()
    return [
        np.log1p(len(line)),
        letters / size,
        count[DIGIT] / size,
        count[CAPITAL] / max(1, letters),
        count[BLANK] / size,
        count[MARK] / size,
        count[SYMBOL] / size,
        count[SHOUT] / size,
        count[BAR] / size,
        count[HIGH] / size,
        np.log1p(len(words)),
        letters / many,
        max(map(len, words), default=0),
        len(set(words)) / many,
        sum(a == b for a, b in zip(words, words[1:])) / many,
        float(bare[-1:] in (b".", b"?", b"!", b":")),
        float(line[:1].isupper()),
        float(seen),
    ]


def text_lines(text: str | None) -> list[bytes]:
    """Lines of a text; an empty or null one has one empty line."""
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def text_stats(lines: list[bytes]) -> np.ndarray:
    known: set[bytes] = set()
    rows = []
    for line in lines:
        rows.append(line_stats(line, bool(line) and line in known))
        known.add(line)
    return np.array(rows, dtype=np.float64).reshape(len(lines), len(STATS))


def weights_of(lines: list[bytes]) -> np.ndarray:
    return np.array([len(line) + 1 for line in lines], dtype=np.float64)


def quantile_cuts(stats: np.ndarray) -> list[np.ndarray]:
    """Borders of each statistic: distinct quantiles of the sample."""
    return [np.unique(np.quantile(column, QUANTILES, method="higher")) for column in stats.T]


def features(stats: np.ndarray, first: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Yes/no features of each line, of the line before and of the line after; ``first`` marks a text's first line."""
    own = np.concatenate([column[:, None] >= cut for column, cut in zip(stats.T, cuts)], axis=1).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first] = 0
    last = np.append(first[1:], True)
    after[last] = 0
    edges = np.stack([np.ones(len(own)), first, last], axis=1).astype(np.float32)
    return np.concatenate([own, before, after, edges], axis=1)


def forward_backward(emit: np.ndarray, lengths: np.ndarray, start: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of every line to be bad and good, expected label pairs, and the log of all labellings' weight.

    ``emit`` is a line's score for good (bad has 0), ``start`` and ``steps`` the
    scores of first labels and of neighbours. Chains are worked on side by side,
    longest first, so that a step handles those that still have a line there.
    """
    many = len(emit)
    weight = np.stack([np.ones(many), np.exp(np.clip(emit, -30, 30))], axis=1)
    move = np.exp(steps)
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max(initial=0))
    alive = np.searchsorted(-lengths[order], -np.arange(longest), side="left")  # chains with more than t lines
    ahead, back, scale = np.empty((many, 2)), np.ones((many, 2)), np.empty(many)
    for t in range(longest):
        rows = begin[: alive[t]] + t
        value = weight[rows] * (ahead[rows - 1] @ move if t else np.exp(start))
        scale[rows] = value.sum(axis=1)
        ahead[rows] = value / scale[rows, None]
    for t in range(longest - 1, 0, -1):
        rows = begin[: alive[t]] + t
        back[rows - 1] = (weight[rows] * back[rows]) @ move.T / scale[rows, None]
    inner = np.ones(many, dtype=bool)
    inner[begin] = False
    rows = np.flatnonzero(inner)
    pairs = move * (ahead[rows - 1].T @ (weight[rows] * back[rows] / scale[rows, None]))
    return ahead * back, pairs, float(np.log(scale).sum())


@dataclass(frozen=True)
class LineCrf:
    """Borders of the statistics, weights of the features, scores of first labels and of neighbours."""

    cuts: list[np.ndarray]
    weights: np.ndarray
    start: np.ndarray
    steps: np.ndarray

    def marginals(self, stats: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Chance of each line to be good, chains of ``lengths`` one after another."""
        first = np.zeros(len(stats), dtype=bool)
        first[np.cumsum(lengths) - lengths] = True
        emit = features(stats, first, self.cuts) @ self.weights
        return forward_backward(emit, lengths, self.start, self.steps)[0][:, 1]


def fit(stats: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> LineCrf:
    """Weights of the largest conditional likelihood with a ridge; ``labels`` holds a 0 or 1 for each chain."""
    cuts = quantile_cuts(stats)
    first = np.zeros(len(stats), dtype=bool)
    first[np.cumsum(lengths) - lengths] = True
    x = features(stats, first, cuts)
    y = np.repeat(labels, lengths).astype(np.float64)
    pairs = np.zeros((2, 2))
    for label in (0, 1):
        pairs[label, label] = (lengths - 1)[labels == label].sum()
    starts = np.array([(labels == 0).sum(), (labels == 1).sum()], dtype=np.float64)
    wide = x.shape[1]
    params, speed, spread = np.zeros(wide + 6), np.zeros(wide + 6), np.zeros(wide + 6)
    for step in range(1, STEPS + 1):
        near, expected, _ = forward_backward(x @ params[:wide].astype(np.float32), lengths, params[wide : wide + 2], params[wide + 2 :].reshape(2, 2))
        up = np.concatenate(
            [
                x.T @ (y - near[:, 1]).astype(np.float32),
                starts - near[first].sum(axis=0),
                (pairs - expected).ravel(),
            ]
        )
        slope = (up - RIDGE * params) / len(lengths)
        speed = 0.9 * speed + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        params = params + RATE * (speed / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return LineCrf(cuts, params[:wide], params[wide : wide + 2], params[wide + 2 :].reshape(2, 2))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: CRC-32 of its identifier as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, docs_bound: int) -> DataFrame:
    """``label, text`` of at most ``docs_bound`` labelled documents, the first by a hash of the identifier.

    Identifiers with contradicting labels are left out; of several rows with one
    identifier the least text counts.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_label_id"))
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .where("label = most")
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(docs_bound)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # broadcast: the limit bounds it
    return (
        rows.join(F.broadcast(known), rows["id"] == known["_label_id"])
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.min("label").alias("label"))
        .select("id", "label", "text")
    )


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs_bound: int = TRAIN_DOCS
) -> LineCrf | None:
    """Model of the bounded sample, or None if no document outside the held-out part is labelled.

    Tasks send the statistics of a document's lines, not its text: at most
    ``docs_bound`` rows of ``DOC_LINES`` lines. Documents are taken by a hash of the
    identifier until ``TRAIN_LINES`` lines are reached.
    """
    sample = training_sample(docs, labels, id_col, text_col, docs_bound).select(
        F.xxhash64("id").alias("key"), F.col("label").cast("int").alias("label"), "text"
    )
    schema = pa.schema([("key", pa.int64()), ("label", pa.int32()), ("stats", pa.binary())])

    def work(batch: pa.RecordBatch) -> dict:
        lines = [text_lines(t) for t in batch.column("text").to_pylist()]
        stats = [text_stats(x).tobytes() if len(x) <= DOC_LINES else None for x in lines]
        return {"key": batch.column("key"), "label": batch.column("label"), "stats": stats}

    rows = map_batches(sample, work, schema).where("stats is not null").collect()
    rows.sort(key=lambda r: (r["key"], bytes(r["stats"])))
    found = [np.frombuffer(bytes(r["stats"])).reshape(-1, len(STATS)) for r in rows]
    upto = int(np.searchsorted(np.cumsum([len(s) for s in found]), TRAIN_LINES, side="right"))
    if not upto:
        return None
    lengths = np.array([len(s) for s in found[:upto]])
    return fit(np.concatenate(found[:upto]), lengths, np.array([r["label"] for r in rows[:upto]]))


def _scored(model: LineCrf | None, texts: list[str | None]) -> list[tuple[list[bytes], np.ndarray]]:
    """Lines of each text and their chances to be good; one half without a model."""
    lines = [text_lines(t) for t in texts]
    lengths = np.array([len(x) for x in lines], dtype=np.int64)
    if model is None or not len(lines):
        return [(x, np.full(len(x), 0.5)) for x in lines]
    good = model.marginals(np.concatenate([text_stats(x) for x in lines]), lengths)
    return list(zip(lines, np.split(good, np.cumsum(lengths)[:-1])))


def label_lines(df: DataFrame, model: LineCrf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>, lines``, an array of ``(line, good, chance)`` in the order of the text.

    A null or empty text has one empty line. An empty table gives no rows.
    """
    line = pa.struct([("line", pa.string()), ("good", pa.bool_()), ("chance", pa.float64())])
    schema = pa.schema([(id_col, to_arrow_type(df.schema[id_col].dataType)), ("lines", pa.list_(line))])

    def work(batch: pa.RecordBatch) -> dict:
        found = _scored(model, batch.column(1).to_pylist())
        lines = [
            [{"line": x.decode("utf-8", "replace"), "good": bool(p >= 0.5), "chance": float(p)} for x, p in zip(*one)] for one in found
        ]
        return {id_col: batch.column(0), "lines": lines}

    return map_batches(df.select(id_col, F.col(text_col).cast("string")), work, schema)


def score_documents(df: DataFrame, model: LineCrf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>, score``, the length-weighted mean chance of its lines to be good (0 to 1).

    Only the text decides. A null text counts as empty; without a model every
    score is 0.5. Repeated rows each get their own; an empty table gives no rows.
    """
    schema = pa.schema([(id_col, to_arrow_type(df.schema[id_col].dataType)), ("score", pa.float64())])

    def work(batch: pa.RecordBatch) -> dict:
        found = _scored(model, batch.column(1).to_pylist())
        scores = [float(np.average(good, weights=weights_of(lines))) for lines, good in found]
        return {id_col: batch.column(0), "score": [round(min(1.0, max(0.0, s)), 6) for s in scores]}

    return map_batches(df.select(id_col, F.col(text_col).cast("string")), work, schema)


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Train on the labelled rows that aren't held out, score all: ``<id_col>, held_out, score, predicted``."""
    found = score_documents(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
