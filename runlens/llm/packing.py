"""Best-fit packing of tokenised documents into sequences of one length.

Documents are tokenised, an end id is added, and only those longer than a
sequence are cut into pieces of its length. Pieces are placed by
bulk-synchronous best fit. Lengths are whole numbers up to the sequence's
length, and pieces of equal length, like gaps of equal size, can stand for
each other: the range-sorted order of all pieces is given by the number of
pieces of each length and a piece's rank within its length, and likewise for
gaps. A sweep gives the pieces of one length, in order of rank, to the smallest
gaps that hold them, updates the gaps, and opens sequences only for pieces
that no gap holds. The sweeps are planned on the driver, on counts by length (at
most 2048 rows, whatever the number of documents), and carried out on Spark for
all pieces at once: a piece finds its place by joining its length and rank with
the sweeps' rank intervals. A join for each sweep would be one job a length.

Ranks within a length are counted in two steps (parts of a length by a hash,
then their running sums), so a length that a third of all pieces have is not
sorted in one task.

Defined cases: a null or empty text is the end id alone; every row is packed,
also rows that repeat an id or have none; an empty table gives an empty one.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import base

LENGTH = 2048
PIECES = "row long, doc_id long, piece int, start long, length long, ids binary"


class _Kept(dict):
    """Values worked out on first use, up to ``keep`` of them."""

    def __init__(self, make, keep: int):
        self.make, self.keep = make, keep

    def __missing__(self, key):
        got = self.make(key)
        if len(self) >= self.keep:
            self.clear()
        self[key] = got
        return got


class WordTokenizer:
    """Token ids of whole texts from a word-wise BPE file of ``tokenizers``.

    The file's rules drop white space and never join over it, so a text's ids
    are those of its parts between spaces and line breaks, each worked out
    once and kept (up to ``keep`` parts). Parts of letters whose normal form
    is themselves go to the model directly; others through the whole file.
    """

    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"     # fixed: the file's own pattern

    def __init__(self, path: str, keep: int = 400_000):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)      # control strings in a text give their own ids, as the file says
        control = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.control = regex.compile("|".join(map(regex.escape, control)) or "(?!)").search
        self.model = self.whole.model
        self.find = regex.compile(self.PIECES).findall
        # the byte alphabet of byte-level BPE: printable bytes stand for
        # themselves, the others follow from code point 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.parts, self.runs = _Kept(self.part, keep), _Kept(self.run, keep)

    def run(self, piece: str) -> bytes:
        """Of a piece without white space or unprintable characters."""
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack("<%dI" % len(ids), *ids)

    def slow(self, part: str) -> bytes:
        return np.array(self.whole.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        if self.control(part):
            return self.slow(part)
        if part.isascii() or "ƀ" > max(part):
            low = part.lower()
            if low.isalpha():                       # one run of letters
                return self.runs[low]
            if low.isprintable() and "\xa0" not in low:
                return b"".join(map(self.runs.__getitem__, self.find(low)))
        return self.slow(part)

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row a piece; ``row`` tells documents apart whatever their ids (to
    be landed before it is used: it depends on how rows are read)."""

    def run(batches):
        import pyarrow as pa

        words = WordTokenizer(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        row = TaskContext.get().partitionId() << 40
        step = 4 * length
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            for a in range(0, batch.num_rows, 256):
                out = [[], [], [], [], [], []]
                for text, doc in zip(texts.slice(a, 256).to_pylist(), ids.slice(a, 256).to_pylist()):
                    row += 1
                    all_ids = words.ids(text) + end
                    for k, i in enumerate(range(0, len(all_ids), step)):
                        cut = all_ids[i: i + step]
                        for c, v in zip(out, (row, doc, k, i // 4, len(cut) // 4, cut)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                     pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.binary())],
                    names=["row", "doc_id", "piece", "start", "length", "ids"])

    return base.texts_of(docs, id_col, text_col).mapInArrow(run, PIECES)


def sweeps(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Place all pieces, given how many there are of each length. Returns
    (piece length, first rank, number, first sequence, offset): the pieces of
    that length and those ranks go to consecutive sequences, at that offset.

    One sweep a length, from long to short: the gaps that hold it are taken
    from the smallest up, each for as many of its pieces as fit, and only what
    is left then opens sequences. Every piece so lies in the smallest gap that
    held it, as by best fit one piece at a time. A sweep's gaps are at most
    ``length`` sizes, each a list of runs of sequences."""
    gaps: dict[int, list[tuple[int, int]]] = {}                    # size: runs of (first sequence, number)
    placed, opened = [], 0

    def run(n: int, rank: int, take: int, first: int, size: int) -> int:
        """The next ``take`` pieces into gaps of one size from ``first`` on,
        one gap filled up after the other; returns what is left of them."""
        each = size // n
        full, rest = divmod(take, each)
        for k in range(each if full else 0):                       # ranks: k-th piece of every full gap
            placed.append((n, rank + k * full, full, first, length - size + k * n))
        for k in range(rest):                                      # and of the last one, which has room left
            placed.append((n, rank + each * full + k, 1, first + full, length - size + k * n))
        for number, start, left in ((full, first, size - each * n), (1 if rest else 0, first + full, size - rest * n)):
            if number and left:
                fresh.setdefault(left, []).append((start, number))
        return full + (1 if rest else 0)

    for n in sorted((n for n, c in counts.items() if c > 0), reverse=True):
        waiting, rank = counts[n], 0
        fresh: dict[int, list[tuple[int, int]]] = {}
        for size in sorted(g for g in gaps if g >= n):
            stock = gaps[size]
            while waiting and stock:
                first, number = stock.pop()
                take = min(waiting, number * (size // n))
                used = run(n, rank, take, first, size)
                rank, waiting = rank + take, waiting - take
                if used < number:
                    stock.append((first + used, number - used))
            if not stock:
                del gaps[size]
            if not waiting:
                break
        if waiting:
            opened += run(n, rank, waiting, opened, length)
        for size, runs in fresh.items():
            gaps.setdefault(size, []).extend(runs)
    return placed


def ranked(lengths: DataFrame, land: base.Landing, parts: int) -> DataFrame:
    """(row, piece, length, rank): ranks from 0 within each length."""
    split = lengths.withColumn("part", F.pmod(F.xxhash64("row", "piece"), F.lit(parts)))
    sizes = split.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "part").orderBy("row", "piece")
    return (split.withColumn("own", F.row_number().over(own) - 1).join(starts, ["length", "part"])
            .select("row", "piece", "length", (F.col("first") + F.col("own")).alias("rank")))


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pieces with their ids, places): join on (row, piece) for sequences."""
    spark = base.session_of(docs)
    base.batches(spark, 4)
    land = base.Landing(spark, "packing")
    cut = land.put(pieces(docs, tokenizer, length, end_id, id_col, text_col), "pieces")
    lengths = cut.select("row", "piece", "length")
    # at most ``length`` rows
    counts = {r["length"]: r["n"] for r in lengths.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = sweeps(counts, length)
    intervals = spark.createDataFrame(
        plan or [(0, 0, 0, 0, 0)], "length long, first long, number long, sequence long, offset long").coalesce(1)
    total = sum(counts.values())
    parts = max(16, total // 1_000_000)
    ranks = ranked(lengths, land, parts)
    # an interval is found by the greatest first rank not above a piece's own:
    # a length's intervals, in order, as one array; a few rows a length
    steps = intervals.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "number", "sequence", "offset"))).alias("steps"))
    steps = land.put(steps, "steps")
    hit = F.filter("steps", lambda s: (s["first"] <= F.col("rank")) & (F.col("rank") < s["first"] + s["number"]))[0]
    places = (ranks.join(F.broadcast(steps), "length").withColumn("hit", hit)
              .select("row", "piece", (F.col("hit.sequence") + F.col("rank") - F.col("hit.first")).alias("sequence_id"),
                      F.col("hit.offset").alias("offset")))
    return cut, land.put(places, "places")


def sequences(cut: DataFrame, places: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` (32-bit, in
    order), ``docs`` (what lies where). A sequence's pieces are at most as
    many as it has tokens."""
    rows = cut.join(places, ["row", "piece"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    return (rows.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id",
                    F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
                    F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("docs")))
