import random

import numpy as np
import pyarrow as pa
import pytest
import zlib

from usagelens.llm._encoder import PieceEncoder
from usagelens.llm.packing import cuts, pack, short_class
from usagelens.llm.token_files import read_sequence, read_token_files, write_token_files

from .brute import DOCS, docs_frame, edge_rows, prose

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library(library):
    rng = random.Random(5)
    signs = list("'' strelvmdD sS.,1 éÉßÀ«’abcXYZ<|>\n\t\x0b\x85\xa0\x1f²½İΣσςñѣſǅ中文​😀×÷")
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["<|endoftext|>", "a<|startoftext|>b it's 'S x''s we'll''d", "", None, prose(4, 500)]
    encoder = PieceEncoder(PATH)
    for _ in range(2):  # new and remembered pieces
        got = []
        for _, ends, ids in encoder.encode(pa.array(texts, pa.string()), 4096):
            got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert got == [ids_of(library, t)[:-1] for t in texts]


def test_token_files_round_trip(spark, tmp_dir, library):
    rows = edge_rows()
    manifest = write_token_files(docs_frame(spark, rows), f"file://{tmp_dir}/t", PATH, length=64)
    got = sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in read_token_files(spark, f"file://{tmp_dir}/t", manifest).collect())
    want = sorted(((r[0] is not None, r[0] or 0), len(ids_of(library, r[1])), crc(ids_of(library, r[1]))) for r in rows)
    assert [g[3] for g in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert sorted(((g[3] is not None, g[3] or 0), g[1], g[2]) for g in got) == want
    at = 0
    for start, n, *_ in got:
        assert start == at
        at += n
    # every sequence by position, and its mask
    text = {r[0]: ids_of(library, r[1]) for r in rows if r[0] == 7}
    start = next(g[0] for g in got if g[3] == 7)
    stream = []
    for m in manifest:
        for k in range(m["n_sequences"]):
            ids, mask = read_sequence(f"file://{tmp_dir}/t", m["file"], k)
            assert len(ids) == len(mask) == 64
            stream += ids[mask].tolist()
    assert stream[start : start + len(text[7])] == text[7]


def test_token_files_empty(spark, tmp_dir):
    manifest = write_token_files(spark.createDataFrame([], DOCS), f"file://{tmp_dir}/e", PATH)
    assert manifest == []
    assert read_token_files(spark, f"file://{tmp_dir}/e", manifest).count() == 0


def test_cuts_fit_their_class():
    for n in range(1, 4096):
        pieces = cuts(n, 4096, 0.015)
        assert sum(length for length, _ in pieces) == n
        assert all(length * k <= 4096 for length, k in pieces) and len(pieces) <= 5
    assert all(short_class(n, 4096) * n <= 4096 for n in range(1, 129))


def check_packing(rows, got, library, capacity):
    """Every id once, sequences gapless and within capacity; returns the share of padding."""
    want = sorted((crc(ids_of(library, r[1])), len(ids_of(library, r[1]))) for r in rows)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            assert crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length
            at += r.length
        assert at <= capacity
        total += capacity if at & (at - 1) else at
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    if None not in by_doc and len(by_doc) == len(rows):
        found = []
        for pieces in by_doc.values():
            ids = [i for _, p, _ in sorted(pieces) for i in p]
            assert all(n == len(ids) for *_, n in pieces)
            found.append((crc(ids), len(ids)))
        assert sorted(found) == want
    assert sum(r.length for r in got) == sum(n for _, n in want)
    return 1 - sum(n for _, n in want) / total


def test_packing_keeps_every_id(spark, library):
    rows = [(i, prose(i, 1 + (i * 37) % 700), "en") for i in range(400)]
    got = pack(docs_frame(spark, rows), PATH, capacity=256, keep_ids=True).collect()
    assert check_packing(rows, got, library, 256) < 0.05


def test_packing_edges(spark, library):
    rows = edge_rows()
    got = pack(docs_frame(spark, rows), PATH, keep_ids=True).collect()
    check_packing(rows, got, library, 4096)
    assert pack(spark.createDataFrame([], DOCS), PATH).count() == 0
