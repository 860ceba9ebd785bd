"""Cross-tokenizer alignment against loops over bytes, and the sparse products against dense ones."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from engrama.llm import alignment

SMALL = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "\n", "a", " a", "a ", "two  spaces", "tab\tand\r\nline", "x\n\ny", "line \nend", "line\n start", "<|endoftext|> plain <s> </s> <unk>",
    "naïve Straße ça ñandú", "日本語の文章", "emoji \U0001F600\U0001F468‍\U0001F469 end", "mark ▁ inside", "\x00 nul", "é combining", "ﬁ ligature",
    "The cat's cat. The cat's cat.\nThe end", "word " * 4000, "ab" * 9000, " nbsp ", "﻿bom", "don't we'll 12345 3.14",
]


def reference(rows):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in printable)}

    def spell_b(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    docs = []
    for doc_id, text in rows:
        a, b, links, groups = [], [], [], []
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False).ids
            b = b_model.encode(text)
            sa = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
            sb = [spell_b(i) for i in b]
            if not b"".join(sa) == b"".join(sb) == (" " + text).encode():
                a, b = [], []
        if a:
            of_a = [i for i, s in enumerate(sa) for _ in s]
            of_b = [i for i, s in enumerate(sb) for _ in s]
            links = sorted(set(zip(of_a, of_b)))
            ends = lambda of: {i + 1 for i in range(len(of)) if i + 1 == len(of) or of[i] != of[i + 1]}
            start = 0
            for cut in sorted(ends(of_a) & ends(of_b)):
                groups.append([[x[i] for i in sorted(set(of[start:cut]))] for x, of in ((a, of_a), (b, of_b))])
                start = cut
        docs.append((doc_id, a, b, groups, [(a[i], b[j]) for i, j in links]))
    count = Counter(p for *_, links in docs for p in set(links))
    highest = defaultdict(int)
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    out = Counter()
    for doc_id, a, b, groups, links in docs:
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out[(doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(spelled.encode()).hexdigest() if a else "", sum(len(x) * len(y) for x, y in groups))] += 1
    return out


def result(df):
    return Counter(tuple(r) for r in df.collect())


def test_all_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = reference(docs.select("doc_id", "text").collect())
    assert result(alignment.align(docs)) == want
    assert result(alignment.align(docs.repartition(6), block_bytes=20_000, batch_bytes=5_000)) == want


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a null id"), (None, None), (3, "an id again"), (3, "an id again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in ("block", "pairs", "n_a", "docs", "place")})
    assert result(alignment.align(docs)) == reference(rows)
    assert result(alignment.align(docs.limit(0))) == Counter()
    assert result(alignment.align(docs.where("text IS NULL"))) == reference([r for r in rows if r[1] is None])


@pytest.mark.parametrize("seed", range(4))
def test_products(seed):
    rng = np.random.default_rng(seed)

    def random_csr(rows, columns):
        dense = rng.random((rows, columns)) < 0.3
        indptr = np.concatenate(([0], np.cumsum(dense.sum(axis=1))))
        return dense.astype(int), alignment.Csr(indptr, np.flatnonzero(dense.ravel()) % columns, columns)

    (da, a), (db, b) = random_csr(7, 9), random_csr(5, 9)
    pattern, values = a.times(b.transposed())
    got = np.zeros((7, 5), int)
    got[pattern.row_of_entries(), pattern.indices] = values
    assert (got == da @ db.T).all()
    assert (a.product_sizes(b.transposed()) == (da @ db.T).sum(axis=1)).all()


def test_shared_groups():
    both = alignment.pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    done = alignment.Aligned(both.encode(["naïve Straße", None, "日本語 text"]), both)
    pattern, values = done.shared_groups()
    pairs = list(zip(pattern.row_of_entries(), pattern.indices))
    ga, gb = done.group_a.indices, done.group_b.indices
    assert pairs == [(i, j) for i in range(len(ga)) for j in range(len(gb)) if ga[i] == gb[j]] and (values == 1).all()
    assert set(zip(done.links.row_of_entries(), done.links.indices)) <= set(pairs)
