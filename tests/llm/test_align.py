"""Token alignment against a plain one that encodes whole texts with both
libraries and compares byte offsets."""

import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from runlens.llm import align
from runlens.llm import queries as q

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SF = "/root/testdata/sf0.001"


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in shown]
        self.byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(rest)}
        vocab = json.load(open(A, encoding="utf-8"))["model"]["vocab"]
        self.entry = {i: t for t, i in vocab.items()}

    def spell_b(self, i):
        return bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def groups(self, text):
        """[(A tokens, B tokens)] of places and ids, by common ends; None without tokens."""
        if not text:
            return None
        want = (" " + text).encode()
        a = [(i, bytes(self.byte[c] for c in self.entry[i])) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.spell_b(i)) for i in self.b.encode(text)]
        if b"".join(s for _, s in a) != want or b"".join(s for _, s in b) != want:
            return None
        out, at_a, at_b, end_a, end_b = [([], [])], 0, 0, 0, 0
        while at_a < len(a) or at_b < len(b):
            if end_a <= end_b and at_a < len(a):
                out[-1][0].append((at_a, a[at_a][0]))
                end_a += len(a[at_a][1])
                at_a += 1
            else:
                out[-1][1].append((at_b, b[at_b][0]))
                end_b += len(b[at_b][1])
                at_b += 1
            if end_a == end_b:
                out.append(([], []))
        return out[:-1]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, docs):
    found = [(doc, plain.groups(text)) for doc, text in docs]
    counts = Counter()
    for _, g in found:
        counts.update({(i, j) for a, b in g or [] for _, i in a for _, j in b})
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for doc, g in found:
        if g is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(i, j) for a, b in g for _, i in a for _, j in b]
        told = ";".join(",".join(str(i) for _, i in a) + "|" + ",".join(str(j) for _, j in b) for a, b in g)
        out.append((doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(told.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "\ta\n\n b  ", "<|endoftext|> x <s> </s> <unk>", "<0x41> <0x0A>",
    "▁ a▁b", "x ▁", "naïve café — “quotes” 日本語 テキスト 🙂🙃 👩‍👩‍👧", "don't we'll I'M 'tis 123456 3.14", "a b 　 c d", "é ﬁ ﬀ",
    "\u0000 \u0001 \x1c x \x1f y", "Ünïcödé über straße ЁЖ привет мир", "     five spaces     and     more", "https://a.b/c?d=e&f=g#h", "\r\n a \r\n",
    "if (x) {\n    return y;\n}\n\n\n", "ﬁ" * 30, "ab" * 500, "same words same words same words",
]


def test_hand_made_texts(spark, plain):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, "no id"), (99, "same words")]
    df = spark.createDataFrame([(d, t, 7, b"x") for d, t in docs], "doc_id long, text string, chunk long, pairs binary")
    assert got(align.scored(df, A, B)) == expected(plain, docs)


def test_empty_table(spark):
    assert got(align.scored(spark.createDataFrame([], "doc_id long, text string"), A, B)) == []


def test_long_texts_and_small_chunks(spark, plain, monkeypatch):
    """Counts come from all chunks; a long text is a chunk of its own."""
    docs = [(i, f"word{i % 5} shared, text number {i}") for i in range(60)] + [
        (100, " ".join(f"token{i % 997}" for i in range(60_000))), (101, "x" * 100_000 + "é" * 3000), (102, " " * 30_000 + "end")]
    tool = align.aligner(A, B)
    monkeypatch.setattr(align, "CHUNK", 400)
    monkeypatch.setattr(align, "BLOCK", 50)
    rows = align.chunk_rows(tool, [t for _, t in docs[:30]])
    assert len(rows["at"]) == 30 and rows["pairs"][0] is not None and rows["pairs"][1] is None
    assert got(align.scored(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), A, B)) == expected(plain, docs)


def test_random_strings_word_by_word(plain):
    import random

    rng = random.Random(3)
    alphabet = "ab c  \n\t'.,1Zé▁日 ​🙂ﬁ<>|"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    rows = align.chunk_rows(align.aligner(A, B), texts)
    for i, t in enumerate(texts):
        g = plain.groups(t)
        told = "" if g is None else hashlib.sha256(";".join(
            ",".join(str(x) for _, x in a) + "|" + ",".join(str(y) for _, y in b) for a, b in g).encode()).hexdigest()
        assert rows["groups_sha256"][i] == told, t


def test_products_against_dense_matrices():
    rng = np.random.default_rng(1)
    for _ in range(30):
        left, right = rng.integers(0, 3, (5, 7)), rng.integers(0, 3, (7, 4))

        def sparse(m):
            r, c = np.nonzero(m)
            return align.gathered(r, c, m[r, c], *m.shape)

        def dense(m):
            out = np.zeros((len(m.ptr) - 1, m.width), int)
            out[m.rows(), m.cols] = m.data
            return out

        assert (dense(align.product(sparse(left), sparse(right))) == left @ right).all()
        assert (dense(align.transposed(sparse(left))) == left.T).all()


def test_token_links(spark, plain):
    docs = [(1, "hello wörld 🙂 unbelievable"), (2, None), (3, "▁")]
    rows = align.token_links(spark.createDataFrame(docs, "doc_id long, text string"), A, B).collect()
    g = plain.groups(docs[0][1])
    inside = {(x, y) for a, b in g for x, _ in a for y, _ in b}
    assert {r["doc_id"] for r in rows} == {1} and sum(r["bytes"] for r in rows) == len((" " + docs[0][1]).encode())
    assert {(r["a_at"], r["b_at"]) for r in rows} <= inside
    assert {(r["a_at"], r["group"]) for r in rows} == {(x, k) for k, (a, _) in enumerate(g) for x, _ in a}


def test_query_by_brute_force(spark, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(q.op11_cross_tokenizer_alignment(spark, SF)) == expected(plain, docs)
