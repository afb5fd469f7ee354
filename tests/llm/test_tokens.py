import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isoloom.llm import packing, token_counts, token_files
from isoloom.llm.queries import tokenizer
from isoloom.llm.tokens import Encoder

BYTES, WORDS = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")
PLAIN = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}
OWN = {p: Encoder(p) for p in (BYTES, WORDS)}


def ids(path, text):
    return PLAIN[path].encode(text or "", add_special_tokens=False).ids


def crc(x):
    return zlib.crc32(np.asarray(x, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB'sé 1 2\n\t\r.,!?  \x1ć日Σς<|endoftext>"), max_size=60))
def test_pieces_encode_like_whole_texts(text):
    for path in (BYTES, WORDS):
        assert np.frombuffer(OWN[path].batch([text])[0], "<u4").tolist() == ids(path, text)


def test_special_strings_encode_like_whole_texts():
    for text in ("a<|endoftext|>b", "A, <|endoftext|> x.", "x <|ENDOFTEXT|>, y", "é.<|startoftext|>\n<|endoftext|>", "don't, can't; won't.\nIT'S.", "a  b.\tc,\u00a0d", "\u0130x, \u1e9e. \u01c5!"):
        for path in (BYTES, WORDS):
            assert np.frombuffer(OWN[path].batch([text, None, "", text])[3], "<u4").tolist() == ids(path, text)


def test_encoder_forgets_and_goes_on(rows):
    small = Encoder(BYTES, limit=50, longest=4)
    for _, t in rows[:40]:
        assert np.frombuffer(small.batch([t])[0], "<u4").tolist() == ids(BYTES, t)


def check_packing(rows, out, capacity):
    seen, places = {}, {}
    for r in out:
        seen.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in rows:
        own = ids(BYTES, t) + [2]
        parts = sorted(seen.pop(i), key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert len(parts) == -(-len(own) // capacity) and all(r.length == capacity for r in parts[1:])
        assert sum(r.length for r in parts) == len(own)
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == crc(own[at : at + r.length])
            at += r.length
    assert not seen
    for got in places.values():
        at = 0
        for offset, length in sorted(got):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in out)
    return len(places), -(-total // capacity)


def test_packing(docs, rows):
    from pyspark.sql import functions as F

    for capacity, bucket in ((1024, 100_000), (64, 20)):
        cut = packing.pieces(docs, BYTES, capacity).withColumn("ids_crc32", F.crc32("ids"))
        out = packing.pack(cut, capacity, bucket_rows=bucket).collect()
        used, least = check_packing(rows, out, capacity)
        assert used <= least * 1.02 + 1


def test_packing_odd(spark, empty, odd):
    assert packing.pack(packing.pieces(empty, BYTES)).count() == 0
    out = packing.pack(packing.pieces(odd, BYTES)).collect()
    assert len(out) == 7 and len({(r.sequence_id, r.offset) for r in out}) == 7


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 500), max_size=12))
def test_plan_uses_each_length_once(histogram):
    left = dict(histogram)
    for pattern, n in packing.plan(histogram, 40):
        assert sum(pattern) <= 40 and n > 0
        for k in pattern:
            left[k] -= n
    assert not any(left.values())


def test_token_counts(docs, rows, empty, odd):
    out = {}
    for r in token_counts.token_counts(docs, BYTES).collect():
        out.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        e = PLAIN[BYTES].encode(t or "", add_special_tokens=False)
        got = sorted(out[i], key=lambda r: r.section)
        lines = (t or "").split("\n")
        assert len(got) == len(lines) and sum(r.n_tokens for r in got) == len(e.ids)
        assert abs(sum(r.token_share for r in got) - len(e.ids)) < 1e-6
        for r, text in zip(got, lines):
            assert (t or "")[r.start_char : r.end_char].rstrip("\n") == text.rstrip("\n")
            assert r.n_tokens == sum(r.start_char <= a < r.end_char for a, b in e.offsets) or not (t or "").isascii()
    assert token_counts.token_counts(empty, BYTES).count() == 0
    assert token_counts.token_counts(odd, BYTES).count() == 7


def test_token_count_rules(spark):
    df = spark.createDataFrame([(1, "ab", "cd ef")], "doc_id long, a string, b string")
    for rule in token_counts.RULES:
        for path in (BYTES, WORDS):
            got = token_counts.token_counts(df, path, ("a", "b"), " ", rule).orderBy("field", "section").collect()
            assert [(r.field, r.section) for r in got] == [("a", 0), ("b", 0), ("b", 1)]
            assert sum(r.n_tokens for r in got) == len(ids(path, "ab cd ef"))


def test_token_files(spark, docs, rows, empty, odd, tmp_path):
    token_files.write_tokens(token_files.encode(docs, WORDS, 2), str(tmp_path / "a"), block_tokens=700)
    got = token_files.read_tokens(spark, str(tmp_path / "a")).orderBy("doc_id").collect()
    at = 0
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    for r, (_, t) in zip(got, rows):
        own = ids(WORDS, t) + [2]
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(own), np.asarray(own, "<u4").tobytes())
        at += len(own)
    token_files.write_tokens(token_files.encode(docs, WORDS, 2, stored=True), str(tmp_path / "s"), block_tokens=700)
    assert token_files.read_tokens(spark, str(tmp_path / "s")).orderBy("doc_id").collect() == got
    token_files.write_tokens(token_files.encode(empty, WORDS, 2, stored=True), str(tmp_path / "t"))
    assert token_files.read_tokens(spark, str(tmp_path / "t")).count() == 0
    token_files.write_tokens(token_files.encode(empty, WORDS, 2), str(tmp_path / "b"))
    assert token_files.read_tokens(spark, str(tmp_path / "b")).count() == 0
    token_files.write_tokens(token_files.encode(odd, WORDS, 2), str(tmp_path / "c"))
    assert token_files.read_tokens(spark, str(tmp_path / "c")).count() == 7
    token_files.write_tokens(token_files.encode(odd.where("text is null"), WORDS), str(tmp_path / "d"))
    assert [bytes(r.ids) for r in token_files.read_tokens(spark, str(tmp_path / "d")).collect()] == [b"", b""]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=300), st.integers(0, 400))
def test_code(counts, n):
    lengths = token_files.code_lengths(np.array(counts))
    assert lengths.max() <= 16 and sum(2.0 ** -int(x) for x in lengths) <= 1
    x = np.random.default_rng(n).integers(0, len(counts), n).astype(np.uint32)
    marks, bits = token_files.pack_block(x, lengths, token_files.code_words(lengths))
    assert token_files.unpack_block(marks, bits, n, *token_files.tables(lengths)).tolist() == x.tolist()


def test_more_ids_than_words_of_the_usual_length():
    counts = np.arange(70_000) % 50 + 1
    lengths = token_files.code_lengths(counts)
    assert lengths.min() > 0 and lengths.max() <= 19 and sum(2.0 ** -lengths.astype(float)) <= 1
    x = np.random.default_rng(5).integers(0, len(counts), 5000).astype(np.uint32)
    marks, bits = token_files.pack_block(x, lengths, token_files.code_words(lengths))
    assert token_files.unpack_block(marks, bits, len(x), *token_files.tables(lengths)).tolist() == x.tolist()


def test_wide_ids_and_repeated_rows(spark, tmp_path):
    rows = [(1, [70_000, 3]), (1, [5]), (None, [9, 9]), (2, []), (2, [])]
    df = spark.createDataFrame([(i, np.array(x, "<u4").tobytes()) for i, x in rows], "doc_id long, ids binary")
    token_files.write_tokens(df, str(tmp_path / "w"))
    got = token_files.read_tokens(spark, str(tmp_path / "w")).collect()
    assert sorted((r.doc_id or 0, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in got) == [(0, [9, 9]), (1, [5]), (1, [70_000, 3]), (2, []), (2, [])]


def test_registered_packing_uses_its_patterns(spark):
    """Fitted patterns fill sequences, and no more are needed than by best fit alone."""
    from isoloom.llm.queries import op2_packing

    for sf in ("sf0.001", "sf0.01"):
        out = op2_packing(spark, f"/root/testdata/{sf}").select("length", "sequence_id").collect()
        histogram = {}
        for r in out:
            histogram[r.length] = histogram.get(r.length, 0) + 1
        patterns = packing.exact_patterns(np.array(sorted(histogram)), 1024)
        x = packing.fit(patterns, np.bincount([r.length for r in out], minlength=1025))
        full = {tuple(sorted((int(k) for k in patterns[i] if k), reverse=True)) for i in np.flatnonzero(x >= 1)}
        chosen = packing.plan(histogram, 1024)
        assert full & {p for p, _ in chosen}
        used = len({r.sequence_id for r in out})
        assert used == sum(n for _, n in chosen) <= sum(n for _, n in packing.best_fit(histogram, 1024))


def test_registered_token_files(spark):
    from isoloom.llm.queries import op9_token_files

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    at = 0
    for r in sorted(op9_token_files(spark, "/root/testdata/sf0.001").collect()):
        own = ids(WORDS, docs.pop(r.doc_id)) + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), crc(own))
        at += len(own)
    assert not docs


def test_code_is_limited():
    lengths = token_files.code_lengths(2 ** np.arange(40))
    assert lengths.max() == 16 and sum(2.0 ** -int(x) for x in lengths) <= 1
