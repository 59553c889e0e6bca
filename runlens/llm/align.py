"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the bytes of space + text into tokens. With the token-byte
incidence matrices A and B (a row a token, a column a byte), the product A·Bᵀ
has an entry for every pair of tokens that share bytes: the overlap links. They
fall into groups where tokens of A and B end at the same byte. The product of
the group incidences (token ids by group, with their numbers) has an entry for
every pair of ids in one group: the shared-group links. Matrices are compressed
rows built by hand from NumPy arrays, products are Gustavson's: a product's row
is the sum of those rows of the right matrix that the left one's row names.

Neither tokenizer joins over a single space between two visible characters (its
pre-tokenizer starts a token there; no piece of the other has a space after
another character, which is looked up in the vocabulary, else texts are not
cut). So a text is a list of words, each aligned once a chunk, and a
document's links are a third product, documents by words times words by id
pairs.

On Spark: documents are aligned in chunks of about ``CHUNK`` bytes of text (or
one longer text). A chunk lists its id pairs with their numbers of documents;
they are summed over the corpus by pair, and each chunk gets back the counts of
its own pairs only, so nothing that grows with the corpus is sent to all tasks.
(The highest count of each id of A is broadcast: no more rows than A's
vocabulary.) A pair has at most one row a chunk, so no key is hot. A task holds
one chunk's arrays and words, and the tokens of at most ``KEEP`` words seen.

Defined cases: null and empty texts, and those whose tokens do not spell space
+ text in either tokenizer (a text with U+2581, say), have no tokens: zeros and
an empty ``groups_sha256``. Every row is a document of its own, also one that
repeats an id or has none. An empty table gives an empty one. Other columns are
not read. A text without spaces is one word, whatever its length.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

CHUNK = 4 << 20
KEEP = 400_000
SHIFT = 32                       # an id pair is a << 32 | b
BLOCK = 1 << 19                  # bytes of words whose matrices are made at a time
WORD_ENDS = re.compile(r"(?<=\S) (?=\S)")
ALIGNED = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "at binary, times binary, pairs array<long>, docs array<long>")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


class Csr(NamedTuple):
    """A sparse matrix by rows: row i has columns ``cols[ptr[i]:ptr[i+1]]``."""
    ptr: np.ndarray
    cols: np.ndarray
    data: np.ndarray
    width: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def pointers(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def gathered(rows: np.ndarray, cols: np.ndarray, data: np.ndarray, height: int, width: int) -> Csr:
    """A matrix from entries in any order; equal places are summed."""
    key = rows * width + cols
    if len(key) and np.any(key[1:] < key[:-1]):
        order = np.argsort(key, kind="stable")
        key, data = key[order], data[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key = key[first]
    data = np.add.reduceat(data, first) if len(first) else data[:0]
    return Csr(pointers(np.bincount(key // width, minlength=height)), key % width, data, width)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.cols, kind="stable")
    return Csr(pointers(np.bincount(m.cols, minlength=m.width)), m.rows()[order], m.data[order], len(m.ptr) - 1)


def product(left: Csr, right: Csr) -> Csr:
    """Gustavson: each entry of ``left`` brings in the row of ``right`` it names."""
    sizes = np.diff(right.ptr)[left.cols]
    starts = pointers(sizes)
    at = np.repeat(right.ptr[left.cols] - starts[:-1], sizes) + np.arange(starts[-1])
    return gathered(np.repeat(left.rows(), sizes), right.cols[at], np.repeat(left.data, sizes) * right.data[at],
                    len(left.ptr) - 1, right.width)


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens of these lengths one after the other."""
    ptr = pointers(lengths)
    return Csr(ptr, np.arange(ptr[-1]), np.ones(ptr[-1], np.int64), int(ptr[-1]))


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Csr:
    """A·Bᵀ: bytes that each pair of tokens shares."""
    return product(incidence(a_lengths), transposed(incidence(b_lengths)))


def groups_of(links: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B token: a group goes on where a token
    of B overlaps two neighbours of A."""
    first, final = links.cols[links.ptr[:-1]], links.cols[links.ptr[1:] - 1]
    a = np.concatenate([[0], np.cumsum(first[1:] != final[:-1])]) if len(first) else np.zeros(0, np.int64)
    b = np.zeros(links.width, np.int64)
    b[links.cols] = a[links.rows()]
    return a, b


class Vocabulary:
    """Byte strings of a tokenizer's ids, and their decimal texts with a mark."""

    def __init__(self, spelled: Sequence[bytes], inner: str, final: str):
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = pointers(self.lengths)[:-1]
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        digits = len(str(len(spelled)))
        marked = np.array([f"{i}{m}".encode() for i in range(len(spelled)) for m in (inner, final)], f"S{digits + 1}")
        self.marked = marked.view(np.uint8).reshape(len(marked), -1)
        self.sizes = (self.marked != 0).sum(1)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.lengths[ids]
        starts = pointers(sizes)
        return self.bytes[np.repeat(self.starts[ids] - starts[:-1], sizes) + np.arange(starts[-1])]


class Words(NamedTuple):
    """Aligned words: figures and group texts of each, and words by id pairs."""
    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    texts: list
    pairs: np.ndarray
    links: Csr


class Aligner:
    """Tokens and alignments of words; ``keep`` bounds the words remembered."""

    def __init__(self, a_path: str, b_path: str, keep: int = KEEP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # byte-level alphabet: printable bytes stand for themselves, others follow from code point 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        with open(a_path, encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        spelled = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            spelled[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.va = Vocabulary(spelled, ",", "|")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.vb = Vocabulary([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                              for i, p in enumerate(pieces)], ",", ";")
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.keep, self.seen = keep, {}

    def split(self, text: str) -> list[str]:
        return WORD_ENDS.split(text) if self.cuts else [text]

    def tokens(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of both tokenizers (32-bit little-endian) of space + each word."""
        new = [w for w in dict.fromkeys(words) if w not in self.seen]
        if len(self.seen) + len(new) > self.keep:
            self.seen = {}
            new = list(dict.fromkeys(words))
        for i in range(0, len(new), 4096):
            part = new[i: i + 4096]
            a = self.a.encode_batch_fast([" " + w for w in part], add_special_tokens=False)
            b = self.b.encode(part, num_threads=1)
            for w, x, y in zip(part, a, b):
                self.seen[w] = np.array(x.ids, "<u4").tobytes(), np.array(y, "<u4").tobytes()
        got = [self.seen[w] for w in words]
        for w in new:
            if len(w) > 256 or len(self.seen) > self.keep:
                del self.seen[w]
        return got

    def align(self, words: list[str]) -> Words:
        """``words`` aligned, in blocks of about ``BLOCK`` bytes."""
        parts, at, size = [], 0, 0
        for i, w in enumerate(words):
            size += len(w) + 1
            if size >= BLOCK or i == len(words) - 1:
                parts.append(self._align(words[at: i + 1]))
                at, size = i + 1, 0
        if not parts:
            return self._align([])
        pairs = np.unique(np.concatenate([p.pairs for p in parts]))
        ptr = pointers(np.concatenate([np.diff(p.links.ptr) for p in parts]))
        cols = np.concatenate([np.searchsorted(pairs, p.pairs)[p.links.cols] for p in parts])
        links = Csr(ptr, cols, np.concatenate([p.links.data for p in parts]), max(1, len(pairs)))
        return Words(*[np.concatenate([p[i] for p in parts]) for i in range(5)],
                     [t for p in parts for t in p.texts], pairs, links)

    def _align(self, words: list[str]) -> Words:
        got = self.tokens(words)
        count = len(words)
        bytes_of = [(" " + w).encode("utf-8", "surrogatepass") for w in words]
        length = np.array([len(b) for b in bytes_of], np.int64)
        sides = []
        good = np.ones(count, bool)
        want = np.frombuffer(b"".join(bytes_of), np.uint8)
        for k, v in enumerate((self.va, self.vb)):
            ids = np.frombuffer(b"".join(g[k] for g in got), "<u4").astype(np.int64)
            owner = np.repeat(np.arange(count), [len(g[k]) // 4 for g in got])
            told = np.bincount(owner, v.lengths[ids], count).astype(np.int64)
            fits = told == length
            good &= fits
            # spelled bytes against the text's, over the words of equal length
            same = v.spell(ids[fits[owner]]) == want[np.repeat(fits, length)]
            good &= np.bincount(np.repeat(np.arange(count)[fits], length[fits]), ~same, count) == 0
            sides.append((ids, owner))
        (a, a_word), (b, b_word) = [(ids[good[owner]], owner[good[owner]]) for ids, owner in sides]
        n_a, n_b = np.bincount(a_word, minlength=count), np.bincount(b_word, minlength=count)
        a_group, b_group = groups_of(overlaps(self.va.lengths[a], self.vb.lengths[b]))
        total = int(a_group[-1]) + 1 if len(a_group) else 0
        a_in, b_in = np.bincount(a_group, minlength=total), np.bincount(b_group, minlength=total)
        word = a_word[np.flatnonzero(np.diff(a_group, prepend=-1))]           # of each group
        n_groups = np.bincount(word, minlength=count)
        n_links = np.zeros(count, np.int64)
        np.add.at(n_links, word, a_in * b_in)
        # ids by group with their numbers; (group, A id) rows times groups by B ids
        one = gathered(a_group, a, np.ones(len(a), np.int64), total, len(self.va.lengths))
        two = gathered(b_group, b, np.ones(len(b), np.int64), total, len(self.vb.lengths))
        each = Csr(np.arange(len(one.cols) + 1), one.rows(), one.data, max(1, total))
        both = product(each, two)
        row = both.rows()
        key = one.cols[row] << SHIFT | both.cols
        pairs, place = np.unique(key, return_inverse=True)
        links = gathered(word[each.cols[row]], place, both.data, count, max(1, len(pairs)))
        return Words(good, n_a, n_b, n_groups, n_links, self._texts(a, b, a_group, b_group, a_in, b_in, word, count), pairs, links)

    def _texts(self, a, b, a_group, b_group, a_in, b_in, word, count) -> list[bytes]:
        """Of each word, its groups as ``a,a|b;`` with decimal ids."""
        a_before, b_before = pointers(a_in), pointers(b_in)
        final_a = np.arange(len(a)) == a_before[1:][a_group] - 1
        final_b = np.arange(len(b)) == b_before[1:][b_group] - 1
        code = np.zeros(len(a) + len(b), np.int64)
        is_b = np.zeros(len(code), bool)
        place_a = np.arange(len(a)) + b_before[:-1][a_group]
        place_b = np.arange(len(b)) + a_before[1:][b_group]
        code[place_a], code[place_b], is_b[place_b] = 2 * a + final_a, 2 * b + final_b, True
        wide = max(self.va.marked.shape[1], self.vb.marked.shape[1])
        out = np.zeros((len(code), wide), np.uint8)
        out[place_a, :self.va.marked.shape[1]] = self.va.marked[code[place_a]]
        out[place_b, :self.vb.marked.shape[1]] = self.vb.marked[code[place_b]]
        sizes = np.where(is_b, 0, self.va.sizes[np.where(is_b, 0, code)]) + np.where(is_b, self.vb.sizes[np.where(is_b, code, 0)], 0)
        owner = np.zeros(len(code), np.int64)
        owner[place_a], owner[place_b] = word[a_group], word[b_group]
        ends = pointers(np.bincount(owner, sizes, count).astype(np.int64)).tolist()
        text = out.ravel()[out.ravel() != 0].tobytes()
        return [text[i:j] for i, j in zip(ends, ends[1:])]


_ALIGNERS: dict = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One a worker process, with the words it has seen."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def chunk_rows(tool: Aligner, texts: list[str | None]) -> dict:
    """The columns of ``ALIGNED`` of one chunk but ``chunk`` and ``doc_id``."""
    local: dict[str, int] = {}
    add = local.setdefault
    coded = [[add(w, len(local)) for w in tool.split(t)] if t else [] for t in texts]
    words = tool.align(list(local))
    # a document with a word that is not spelled right is judged as a whole
    odd = [i for i, c in enumerate(coded) if c and not words.good[c].all()]
    if odd:
        for i in odd:
            coded[i] = [add(texts[i], len(local))]
        words = tool.align(list(local))
        for i in odd:
            if not words.good[coded[i][0]]:
                coded[i] = []
    count = len(texts)
    sizes = np.array([len(c) for c in coded])
    unit = np.fromiter((u for c in coded for u in c), np.int64, int(sizes.sum()))
    used = gathered(np.repeat(np.arange(count), sizes), unit, np.ones(len(unit), np.int64), count, max(1, len(local)))
    held = product(used, words.links)
    some, docs = np.unique(held.cols, return_counts=True)
    at = np.searchsorted(some, held.cols)
    doc = used.rows()
    sums = {c: np.zeros(count, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    for name, out in sums.items():
        np.add.at(out, doc, getattr(words, name)[used.cols] * used.data)
    digests = [hashlib.sha256(b"".join([words.texts[u] for u in c])[:-1]).hexdigest() if c else "" for c in coded]
    cut = held.ptr.tolist()
    places, times = at.astype("<u4"), held.data.astype("<u4" if not len(held.data) or held.data.max() < 1 << 32 else "<u8")
    return {**sums, "groups_sha256": digests, "at": [places[i:j].tobytes() for i, j in zip(cut, cut[1:])],
            "times": [times[i:j].tobytes() for i, j in zip(cut, cut[1:])],
            "pairs": [words.pairs[some]] + [None] * (count - 1), "docs": [docs] + [None] * (count - 1)}


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document, with its place in a chunk's list of id pairs (on the
    chunk's first row); to be landed, as chunks depend on how rows are read."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        tool = aligner(a_path, b_path)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            i = 0
            while i < len(ends):
                told = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, told + CHUNK, "right")))
                got = chunk_rows(tool, texts.slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(j - i, chunk)), ids.slice(i, j - i).cast(pa.int64()),
                     *[pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                     pa.array(got["groups_sha256"]), pa.array(got["at"], pa.binary()), pa.array(got["times"], pa.binary()),
                     pa.array(got["pairs"], pa.list_(pa.int64())), pa.array(got["docs"], pa.list_(pa.int64()))],
                    names=["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times", "pairs", "docs"])
                chunk += 1
                i = j

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ALIGNED)


def held_pairs(chunks: DataFrame) -> DataFrame:
    """(chunk, place, pair, docs): the id pairs of every chunk."""
    return (chunks.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p"))
            .select("chunk", "place", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs")))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a_id, b_id, n_docs, best): how many documents hold each pair linked,
    and whether no other pair of its A id has more."""
    counts = held_pairs(chunks).groupBy("pair").agg(F.sum("docs").alias("n_docs"))
    counts = counts.select("pair", F.shiftrightunsigned("pair", SHIFT).alias("a_id"),
                           F.col("pair").bitwiseAND((1 << SHIFT) - 1).alias("b_id"), "n_docs")
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))        # a row an id of A's vocabulary
    return counts.join(F.broadcast(most), "a_id").select("pair", "a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def scored(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Figures of every document's alignment; see the module's text."""
    land = base.Landing(base.session_of(docs), "align")
    chunks = land.put(aligned(docs, a_path, b_path), "chunks")
    counts = land.put(pair_counts(chunks), "counts")
    told = held_pairs(chunks).join(counts.select("pair", "n_docs", "best"), "pair").select(
        F.col("chunk").alias("of"), "place", "n_docs", "best")

    def sums(left, right):
        import pyarrow as pa

        n = np.zeros(right.num_rows, np.int64)
        best = np.zeros(right.num_rows, bool)
        place = right.column("place").to_numpy()
        n[place] = right.column("n_docs").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for at, times in zip(left.column("at").to_pylist(), left.column("times").to_pylist()):
            at = np.frombuffer(at, "<u4")
            times = np.frombuffer(times, "<u4" if len(times) == 4 * len(at) else "<u8").astype(np.int64)
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((times * n[at]).sum()))
        same = {c: left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table({**same, "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                         "groups_sha256": left.column("groups_sha256")})

    return chunks.drop("pairs", "docs").groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(sums, RESULT)


def token_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The overlap links themselves, a row each: ``doc_id``, the places
    ``a_at``, ``b_at`` of two tokens in their document, their ids, the bytes
    they share, and their group."""

    def run(batches):
        import pyarrow as pa

        tool = aligner(a_path, b_path)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                a, b = [np.frombuffer(x, "<u4").astype(np.int64) for x in tool.tokens([text])[0]] if text else (np.zeros(0, int),) * 2
                want = (" " + text).encode() if text else b""
                if tool.va.spell(a).tobytes() != want or tool.vb.spell(b).tobytes() != want or not text:
                    continue
                links = overlaps(tool.va.lengths[a], tool.vb.lengths[b])
                rows = links.rows()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(rows), pa.int64()), pa.array(rows), pa.array(links.cols), pa.array(a[rows]),
                     pa.array(b[links.cols]), pa.array(links.data), pa.array(groups_of(links)[0][rows])],
                    names=["doc_id", "a_at", "b_at", "a_id", "b_id", "bytes", "group"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, a_at long, b_at long, a_id long, b_id long, bytes long, `group` long")
