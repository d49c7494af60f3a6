"""Collocations of two to four words, counted on frequency-ranked numbers in tiles.

Texts become *chunks*: the word numbers of some hundred thousand words of one
language, with a gap after every piece, and the chunk's own word list. Words that are frequent enough are
ranked by frequency over the whole table. A chunk then holds its units in that order, so pairs of
frequent units meet in the first of the ``TILE`` x ``TILE`` tiles that the pair
numbers fall into: full tiles are counted by direct address (``bincount``), the others together as
sorted coordinates. Frequent pairs are ranked in turn and become the units of the
next round: a unit of three words is a pair of units of two that overlap in one, and
so on, so one counting step serves every length.

Counts leave a task as one row per chunk and distinct pair, and Spark adds them up. A
chunk learns the ranks of its units by a join: of the unit table with the chunk's
distinct units, not with its positions. The table is broadcast only where its measured size allows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abode.llm.tables import forget, stored
from abode.operators.snapshot import assign_ids
from abode.plans.joins import bounded_broadcast

#: Words a chunk closes at; it holds whole texts, so one long text can make it larger.
CHUNK = 1 << 18
TILE = 512
#: Pairs from which a tile is counted by direct address.
FULL = TILE * TILE // 16
LEAST, LONGEST, TOP = 30, 4, 2000
SHARES = 16
CHUNKS_AT_A_TIME = 2  # a chunk's row is a megabyte or two
CODEC = "zstd"  # of stored chunks: two thirds of their size otherwise
UNKNOWN = "und"

#: Characters that end a piece, as one of them.
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


class _Numbers(dict):
    """Numbers words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``chunk, lang, codes, words, counts``; codes are places in ``words``, or -1 for a gap."""
    task = TaskContext.get().partitionId() << 33
    open_: dict[str, tuple[_Numbers, array]] = {}
    made = 0

    def close(lang: str) -> pa.RecordBatch:
        numbers, codes = open_.pop(lang)
        found = np.frombuffer(codes, dtype=np.int32)
        counts = np.bincount(found[found >= 0], minlength=len(numbers))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([task + made], pa.int64()),
                pa.array([lang], pa.string()),
                pa.array([found.tobytes()], pa.binary()),
                pa.array([list(numbers)], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                pa.array([counts], pa.list_(pa.int64())),
            ],
            names=["chunk", "lang", "codes", "words", "counts"],
        )

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            lang = lang.as_py()
            numbers, codes = open_.setdefault(lang, (_Numbers(), array("i")))
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().translate(ENDS)
            for piece in raw.split(b"\n"):
                words = piece.split()
                if words:
                    codes.extend(map(numbers.__getitem__, words))
                    codes.append(-1)
            if len(codes) >= CHUNK:
                yield close(lang)
                made += 1
            elif sum(len(c) for _, c in open_.values()) >= 8 * CHUNK:  # many languages with few words each
                for other in list(open_):
                    yield close(other)
                    made += 1
    for lang in list(open_):
        if len(open_[lang][1]):
            yield close(lang)
            made += 1


def pairs(codes: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct neighbours among ranks below ``many``: first, second, count; the places they stand at, and which of them stands there."""
    left, right = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
    at = np.flatnonzero((left >= 0) & (right >= 0))
    left, right = left[at], right[at]
    across = many // TILE + 1
    tile = left // TILE * across + right // TILE
    cell = left % TILE * TILE + right % TILE
    sizes = np.bincount(tile, minlength=1) if across * across <= 4 * len(tile) + TILE else None
    if sizes is None:  # far more tiles than pairs: only those that occur
        numbers, tile_of, sizes = np.unique(tile, return_inverse=True, return_counts=True)
    else:
        numbers, tile_of = np.arange(len(sizes)), tile
    full = np.flatnonzero(sizes >= FULL)
    out_left, out_right, out_n = [], [], []
    which = np.empty(len(at), dtype=np.int64)
    base = 0

    def add(cells: np.ndarray, tiles: np.ndarray, counts: np.ndarray) -> None:
        out_left.append(tiles // across * TILE + cells // TILE)
        out_right.append(tiles % across * TILE + cells % TILE)
        out_n.append(counts)

    sparse = np.ones(len(at), dtype=bool)
    for number in full:
        inside = np.flatnonzero(tile_of == number)
        counts = np.bincount(cell[inside], minlength=TILE * TILE)
        found = np.flatnonzero(counts)
        place = np.empty(TILE * TILE, dtype=np.int64)
        place[found] = base + np.arange(len(found))
        which[inside] = place[cell[inside]]
        add(found, np.full(len(found), numbers[number]), counts[found])
        sparse[inside] = False
        base += len(found)
    rest = np.flatnonzero(sparse)
    keys, inverse, counts = np.unique(tile[rest] * (TILE * TILE) + cell[rest], return_inverse=True, return_counts=True)
    which[rest] = base + inverse
    add(keys % (TILE * TILE), keys // (TILE * TILE), counts)
    return np.concatenate(out_left), np.concatenate(out_right), np.concatenate(out_n), at, which


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, str, np.ndarray, np.ndarray]]:
    for chunk, lang, codes, units in zip(batch.column("chunk"), batch.column("lang"), batch.column("codes"), batch.column("units")):
        yield chunk.as_py(), lang.as_py(), np.frombuffer(codes.as_py(), dtype=np.int32), np.frombuffer(units.as_py(), dtype=np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``chunk, place, first, second, n``: the distinct pairs of each chunk, numbered by ``place``."""
    for batch in batches:
        for chunk, _, codes, units in _read(batch):
            left, right, n, _, _ = pairs(codes, len(units))
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": np.full(len(n), chunk),
                    "place": np.arange(len(n), dtype=np.int32),
                    "first": units[left],
                    "second": units[right],
                    "n": n.astype(np.int64),
                }
            )


def _recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in units of the next round, from ``place -> unit`` of what is frequent.

    The first round's codes are places already; later ones stand for pairs, which
    :func:`pairs` finds in the same order as when they were counted.
    """
    for batch in batches:
        for (chunk, lang, codes, units), places, ranks in zip(_read(batch), batch.column("places"), batch.column("ranks")):
            places = places.values.to_numpy(zero_copy_only=False)
            ranks = ranks.values.to_numpy(zero_copy_only=False)
            if len(units):
                _, _, n, at, which = pairs(codes, len(units))
                known = len(n)
            else:
                at = np.flatnonzero(codes >= 0)
                which, known = codes[at], int(codes.max(initial=-1)) + 1
            own = np.sort(ranks)
            local = np.full(known, -1, dtype=np.int32)
            local[places] = np.searchsorted(own, ranks)
            out = np.full(len(codes), -1, dtype=np.int32)
            out[at] = local[which]
            yield pa.RecordBatch.from_pydict(
                {"chunk": [chunk], "lang": [lang], "codes": [out.tobytes()], "units": [own.astype(np.int64).tobytes()]}
            )


CODED = "chunk long, lang string, codes binary, units binary"


def _next_chunks(chunks: DataFrame, requests: DataFrame, units: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Chunks coded in ``units``; ``requests`` are each chunk's distinct units by ``place`` and ``keys``."""
    wanted, _ = bounded_broadcast(units.select(*keys, "unit"))
    known = requests.join(wanted, keys).groupBy("chunk").agg(F.collect_list(F.struct("place", "unit")).alias("_known"))
    # one list per chunk, of at most as many entries as the chunk has words
    joined = chunks.join(known, "chunk").select(
        "chunk", "lang", "codes", "units", F.col("_known.place").alias("places"), F.col("_known.unit").alias("ranks")
    )
    return stored(joined.mapInArrow(_recode, CODED), name, CODEC, CHUNKS_AT_A_TIME)


def _ranked(units: DataFrame, ties: list[str]) -> DataFrame:
    """``unit`` numbers in the order of language, falling count and ``ties``."""
    named = units.withColumn("_less", -F.col("a"))
    return assign_ids(named, ["lang", "_less", *ties], 0, id_col="unit")[0].drop("_less")


def _longer(counts: DataFrame, units: DataFrame) -> DataFrame:
    """Frequent pairs of units as phrases: ``first, second, lang, a, words, heads, tails``.

    ``heads`` and ``tails`` hold the counts of the phrase's first and last 1, 2, …
    words: those of its two units, and its own.
    """
    first = units.select(F.col("unit").alias("first"), "lang", F.col("words").alias("_w"), F.col("heads").alias("_h"))
    second = units.select(F.col("unit").alias("second"), F.element_at("words", -1).alias("_last"), F.col("tails").alias("_t"))
    return (
        counts.join(first, "first")
        .join(second, "second")
        .select(
            "first",
            "second",
            "lang",
            "a",
            F.concat("_w", F.array("_last")).alias("words"),
            F.concat("_h", F.array("a")).alias("heads"),
            F.concat("_t", F.array("a")).alias("tails"),
        )
    )


def _scored(phrases: DataFrame, longer: DataFrame | None) -> DataFrame:
    """Candidates with their lowest-scoring cut, without those a longer candidate covers.

    A longer candidate that covers a phrase implies one that is longer by a single word,
    and the phrase is a unit of that.
    """
    if longer is not None:
        both = longer.select(F.col("first").alias("unit"), "a").unionByName(longer.select(F.col("second").alias("unit"), "a"))
        covers = both.groupBy("unit").agg(F.max("a").alias("_longer"))
        phrases = phrases.join(covers, "unit", "left").where("_longer is null or 100 * _longer < 80 * a")
    cut = """array_min(transform(sequence(1, size(words) - 1), k -> named_struct(
        'score', (cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0))) div cast(heads[k - 1] + tails[size(words) - k - 1] as decimal(20,0)),
        'k', k, 'l', heads[k - 1], 'r', tails[size(words) - k - 1])))"""
    return phrases.withColumn("_cut", F.expr(cut)).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"),
        F.col("_cut.score").alias("score"),
    )


def collocations(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases by score, count and text.

    Texts are lower-cased (A-Z) and cut into pieces and words; phrases lie within
    a piece. ``a`` counts all occurrences of a phrase, ``n`` the language's words,
    ``l`` and ``r`` the two parts of the cut of lowest ``score``, floor(2000000 a / (l + r)).
    Candidates occur ``least`` times or more; one whose words stand in a longer candidate
    with at least 80 % of its count is left out.

    A null language counts as ``und``, a null text as empty. Repeated rows count each time.
    A table without words, or without phrases as frequent as ``least``, gives no
    rows; other columns are not read.
    """
    texts = df.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    chunks = stored(
        texts.mapInArrow(_chunks, "chunk long, lang string, codes binary, words array<string>, counts array<long>"), "chunks", CODEC
    )
    total = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    listed = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "_w"))
    words = (
        listed.groupBy("lang", F.col("_w.words").alias("word"))
        .agg(F.sum("_w.counts").alias("a"))
        .where(F.col("a") >= least)
    )
    # stored, so that the shuffle files of the counts go before the next step
    units = _ranked(stored(words, "words"), ["word"]).select(
        "unit", "lang", "a", "word", F.array("word").alias("words"), F.array("a").alias("heads"), F.array("a").alias("tails")
    )
    requests = listed.select("chunk", "place", "lang", F.col("_w.words").alias("word"))
    coded = _next_chunks(chunks.withColumn("units", F.lit(b"")), requests, units, ["lang", "word"], "units_1")
    total = stored(total, "totals")
    forget(chunks)

    found = []
    for length in range(2, LONGEST + 1):
        counted = coded.mapInArrow(_count, "chunk long, place int, first long, second long, n long")
        counts = counted.groupBy("first", "second").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
        phrases = _ranked(_longer(stored(counts, f"counts_{length}", arrow_rows=CHUNKS_AT_A_TIME), units), ["first", "second"])
        found.append(phrases)
        if length < LONGEST:
            requests = counted.select("chunk", "place", "first", "second")
            following = _next_chunks(coded, requests, phrases, ["first", "second"], f"units_{length}")
            forget(coded)
            coded, units = following, phrases
    forget(coded)

    rows = None
    for phrases, longer in zip(found, [*found[1:], None]):
        one = _scored(phrases, longer)
        rows = one if rows is None else rows.unionByName(one)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # first by shares of a language, so that the task that ranks it reads SHARES x top rows at most
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    rows = rows.withColumn("_in_share", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order)))
    rows = rows.where(F.col("_in_share") <= top)
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
