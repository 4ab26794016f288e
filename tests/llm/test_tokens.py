"""Token files, packing and the shared encoder against the tokenizers library."""

import collections
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from screenroi.llm.packing import LocalSearch, best_fit, pack, pack_documents
from screenroi.llm.token_files import (
    ShardReader, ShardWriter, id_bits, pack as pack_bits, read_token_files, token_files, unpack, write_token_files,
)
from screenroi.llm.tokens import Encoder, tokenizer_path


def ids_of(text):
    return Encoder.of(tokenizer_path()).tok.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TEXTS = ["", "  ", " a", "a ", "a  b", "a   b\n\n c", "\n", "x\n y", " \n ", "tab\t a", "é  b  c", None,
         "<|endoftext|> hi <|endoftext|>", "it's 'll \u0085 x", "a\x0b b\x1c c\x1f d", "\x1c \x1d", " " * 50 + "a",
         "a\r\n b 12 345 ,,, ...  ", "don't I'll we've\nThe.End\n\nnew", "　wide　 x", "a  b"]


def test_encoder_equals_library():
    ids, ends = Encoder(tokenizer_path()).encode(pa.array(TEXTS))
    for k, text in enumerate(TEXTS):
        assert ids[ends[k]:ends[k + 1]].tolist() == ids_of(text)[:-1], repr(text)


def test_encoder_equals_library_on_random_texts():
    rng = random.Random(1)
    parts = ["a", "Zb", "é", "1", "23", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'ll", "-", "–", "😀", "\u0301",
             "\u00a0", "ﬁ", "_", "the", "\r\n", "$", "中文", "'", "ss"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(20000)]
    encoder = Encoder(tokenizer_path())
    ids, ends = encoder.encode(pa.array(texts))
    want = encoder.tok.encode_batch_fast(texts, add_special_tokens=False)
    assert not [t for k, t in enumerate(texts) if ids[ends[k]:ends[k + 1]].tolist() != want[k].ids]


def test_encoder_cache_bound(monkeypatch):
    import screenroi.llm.tokens as module

    monkeypatch.setattr(module, "CACHE_PIECES", 20)
    encoder = Encoder(tokenizer_path())
    for word in ("alpha beta gamma delta", "one two three four five six", "alpha beta gamma delta") * 4:
        ids, _ = encoder.encode(pa.array([word]))
        assert ids.tolist() == ids_of(word)[:-1]
        assert len(encoder.known) <= 26


def test_encoder_takes_pieces_in_blocks():
    import screenroi.llm.packing as packing

    encoder = Encoder(tokenizer_path())
    library, calls = encoder.tok, []

    class Seen:
        def encode_batch_fast(self, pieces, **options):
            calls.append(len(pieces))
            return library.encode_batch_fast(pieces, **options)

    encoder.tok = Seen()
    text = " ".join(f"w{k}x{k * k}" for k in range(20000))
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == ids_of(text)[:-1] and len(calls) > 2 and max(calls) <= 8192

    laid_out = []
    encoder.encode = lambda texts: laid_out.append(pc.sum(pc.binary_length(texts)).as_py()) or Encoder.encode(encoder, texts)
    Encoder._own["seen"] = encoder
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(9)), "text": pa.array([text * 2] * 9)})
    out = list(packing._cutter("seen", 1024, 2)(iter([batch])))
    del Encoder._own["seen"]
    assert sum(sum(o.column("length").to_pylist()) for o in out) == 9 * len(ids_of(text * 2))
    assert len(out) > 1 and max(laid_out) <= 2 << 20 < sum(laid_out)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype(np.uint32)
    data = pack_bits(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (unpack(data, bits, 1001) == ids).all()


def test_id_bits():
    assert [id_bits(n) for n in (1, 2, 3, 256, 257, 50257, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_shard_random_access(tmp_path):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 5000, n).astype(np.uint32) for n in (1, 300, 0, 77, 1000)]
    with open(tmp_path / "x.ids", "wb") as out:
        writer = ShardWriter(out, 13, block_ids=64)
        for k, ids in enumerate(docs):
            writer.add(ids, np.array([len(ids)]), [k if k != 2 else None])
        writer.close()
    flat = np.concatenate(docs)
    with open(tmp_path / "x.ids", "rb") as file:
        shard = ShardReader(file)
        assert shard.doc_ids.tolist() == [0, 1, 0, 3, 4] and shard.nulls.tolist() == [0, 0, 1, 0, 0]
        for a, b in ((0, 1), (63, 65), (0, len(flat)), (400, 400), (1000, len(flat))):
            assert (shard.ids(a, b) == flat[a:b]).all()


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_token_files(table, request):
    docs = request.getfixturevalue(table)
    got = token_files(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(r.doc_id), len(ids_of(r.text)), crc(ids_of(r.text))) for r in rows)
    at = 0
    ids = []
    for r in sorted(got, key=lambda r: r.start):  # gapless, ascending, nulls first
        assert r.start == at
        at += r.n_tokens
        ids.append(r.doc_id)
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_shards_divide_a_hot_row(spark, tmp_path):
    """One row repeated through a third of the table is spread over shards; places still add up."""
    docs = spark.range(9000).selectExpr("if(id % 3 = 0, 4000L, id) AS doc_id", "if(id % 3 = 0, 'hot', concat('t ', id)) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_token_files(docs.repartition(6, "text"), str(tmp_path))
        sizes = [r.n_docs for r in manifest.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 9000 and max(sizes) < 2500
    rows = sorted(read_token_files(manifest, str(tmp_path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in docs.collect())
    assert all(a.start + a.n_tokens == b.start for a, b in itertools.pairwise(rows))


def test_token_files_written_twice(documents, tmp_path):
    """A second writer of the same folder replaces whole files."""
    root = f"file://{tmp_path}/files"
    write_token_files(documents, root)
    manifest = write_token_files(documents, root, block_ids=100)
    assert read_token_files(manifest, root).count() == documents.count()
    assert not [p for p in (tmp_path / "files").iterdir() if p.name.startswith("_attempt")]


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_packing(table, request):
    docs = request.getfixturevalue(table)
    got = pack_documents(docs).collect()
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    want = collections.Counter()
    total = 0
    for r in docs.select("doc_id", "text").collect():
        ids = ids_of(r.text)
        total += len(ids)
        head = len(ids) - (-(-len(ids) // 1024) - 1) * 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r.doc_id, k, a, b - a, crc(ids[a:b])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert len(sequences) <= -(-total // 1024) * 1.03 + 4


def test_local_search_empties_bins():
    lengths = np.random.default_rng(3).integers(200, 600, 1500)
    first = best_fit(lengths, 1024)
    search = LocalSearch([list(b) for b in first], lengths, 1024)
    squares = int((search.fill ** 2).sum())
    found = search.run()
    assert sorted(k for b in found for k in b) == list(range(1500))
    fills = [int(lengths[b].sum()) for b in found]
    assert max(fills) <= 1024 and len(found) < len(first) and sum(f * f for f in fills) > squares


@pytest.mark.parametrize("n, low, high", [(10000, 20, 200), (20000, 20, 200), (600, 200, 600)])
def test_local_search_leaves_no_step(n, low, high):
    """Bins of many short documents exchange too, and at the end no move, 1:1 or 2:1 exchange into a fuller bin is left."""
    lengths = np.random.default_rng(3).integers(low, high + 1, n)
    first = best_fit(lengths, 1024)
    found = LocalSearch([list(b) for b in first], lengths, 1024).run()
    assert sorted(k for b in found for k in b) == list(range(n))
    fills = [int(lengths[b].sum()) for b in found]
    assert max(fills) <= 1024 and len(found) < len(first)
    if sum(1024 - f for f in fills) < 1024:
        return  # no packing is shorter
    own = [sorted(lengths[b].tolist()) for b in found]
    gives = [{0, *x, *(p + q for p, q in itertools.combinations(x, 2))} for x in own]
    under = [b for b, f in enumerate(fills) if f < 1024]
    for a in under:
        for b in under:
            if a != b and fills[b] >= fills[a]:
                steps = {(piece, g) for piece in own[a] for g in gives[b] if 0 < piece - g <= 1024 - fills[b]}
                assert not steps, (own[a], own[b])


def test_pack_extremes():
    for lengths in ([], [1024], [1], [1024, 1, 1023], [512] * 7, [1] * 3000):
        bins = pack(np.array(lengths, np.int64))
        assert sorted(k for b in bins for k in b) == list(range(len(lengths)))
        assert len(bins) == -(-sum(lengths) // 1024)


@pytest.mark.parametrize("operator", [token_files, pack_documents])
def test_empty(operator, empty):
    assert operator(empty).count() == 0
