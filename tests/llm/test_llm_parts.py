"""Methods of the text operators on their own: codes, packing, chains, records."""

from itertools import product

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tidemark.llm import crf, huffman, language, packing, toxicity, warc
from tidemark.llm.spans import PLAIN_WORD, TextBatch, sliding_minimum
from tidemark.llm.tokens import Encoder

TEXT = st.text(st.sampled_from("abAB é,.'!\n\t1…ßΣ<|>"), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_are_those_of_the_expression(texts):
    words = TextBatch(pa.array(texts, pa.string())).words(PLAIN_WORD, lower=True)
    want = [w for t in texts for w in brute.plain_words(t)]
    assert [w.decode() for w in words.binary().to_pylist()] == want
    assert words.counts.tolist() == [len(brute.plain_words(t)) for t in texts]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_ids_are_the_tokenizers(encoder, texts):
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    want = brute.token_ids(texts)
    assert counts.tolist() == [len(x) - 1 for x in want]
    assert ids.tolist() == [int(i) for x in want for i in x[:-1]]


def test_ids_with_special_strings(encoder):
    texts = ["a<|endoftext|>b", "A<|ENDOFTEXT|>B it's", None, "", "İx ΣΑΣ don't…, é"]
    ids, counts = encoder.encode(pa.array(texts))
    want = brute.token_ids(texts)
    assert ids.tolist() == [int(i) for x in want for i in x[:-1]]


@pytest.mark.parametrize("w", [1, 2, 5, 9])
def test_sliding_minimum(w):
    values = np.random.default_rng(w).integers(0, 50, 40).astype(np.uint64)
    assert sliding_minimum(values, w).tolist() == [min(values[i : i + w]) for i in range(41 - w)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=40), st.integers(6, 12))
def test_code_lengths(counts, longest):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, longest)
    used = lengths[counts > 0].astype(int)
    assert (lengths[counts == 0] == 0).all()
    assert (used <= longest).all()
    if len(used) > 1:
        assert sum(2.0**-n for n in used) == 1.0
        codes = huffman.canonical(lengths)
        written = {format(int(c), f"0{n}b") for c, n in zip(codes, lengths, strict=True) if n}
        assert len(written) == len(used)
        assert not any(a != b and b.startswith(a) for a, b in product(written, written))


def test_codes_are_shortest():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21])
    free = huffman.code_lengths(counts, 18)
    assert free.tolist() == [7, 7, 6, 5, 4, 3, 2, 1]
    bound = huffman.code_lengths(counts, 4)
    best = min(
        int((counts * np.array(n)).sum())
        for n in product(range(1, 5), repeat=8)
        if sum(2.0**-x for x in n) <= 1
    )
    assert int((counts * bound).sum()) == best


def test_codes_round_trip():
    random = np.random.default_rng(1)
    sizes = np.array([1, 255, 256, 257, 3000, 0, 2])
    ids = random.zipf(1.3, sizes.sum()) % 5000
    lengths = huffman.code_lengths(np.bincount(ids, minlength=5000), 14)
    payload, n_bytes, checks, n_checks = huffman.encode(ids, sizes, lengths, huffman.canonical(lengths))
    first = np.cumsum(n_checks) - n_checks
    run = np.cumsum(checks.astype(np.int64))
    base = np.repeat(run[np.minimum(first, len(run) - 1)], n_checks)
    starts = run - base + np.repeat(8 * (np.cumsum(n_bytes) - n_bytes), n_checks)
    left = np.full(len(starts), huffman.CHECK)
    full = n_checks > 0
    left[(first + n_checks - 1)[full]] = (sizes - huffman.CHECK * (n_checks - 1))[full]
    table = huffman.decode_table(lengths, 14)
    assert huffman.decode(payload, starts, left, table, 14).tolist() == ids.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_plans_use_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=17) if lengths else np.zeros(17, int)
    bins = packing.plan(counts, 16)
    used = np.zeros(17, int)
    for times, pieces in bins:
        assert sum(pieces) <= 16
        used += times * np.bincount(pieces, minlength=17)
    assert used.tolist() == counts.tolist()
    n = sum(times for times, _ in bins)
    assert n <= 1.25 * -(-sum(lengths) // 16) + 1 or n <= len(lengths)


def test_two_pieces_replace_the_smallest():
    assert sorted(packing.best_two(np.bincount([1, 2, 2], minlength=11), 3, 2)) == [1, 2]
    assert packing.best_two(np.bincount([2], minlength=11), 4, 2) == (0, 0)
    counts = np.bincount([6, 3, 2, 2], minlength=11)
    assert packing.plan(counts, 10)[0] == (1, [6, 2, 2])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=4), st.integers(0, 9999))
def test_chains_against_enumeration(sizes, seed):
    random = np.random.default_rng(seed)
    sizes = np.array(sizes)
    starts = np.cumsum(sizes) - sizes
    scores, moves = random.normal(size=(sizes.sum(), 3)), random.normal(size=(3, 3))
    lanes = crf.Lanes.of(starts, sizes)
    found, expected = crf.marginals(scores, lanes, moves, pairs=True)
    best = crf.best_labels(scores, lanes, moves)
    pairs = np.zeros((3, 3))
    for start, n in zip(starts, sizes, strict=True):
        ways = {}
        for way in product(range(3), repeat=int(n)):
            s = sum(scores[start + i, k] for i, k in enumerate(way))
            ways[way] = s + sum(moves[a, b] for a, b in zip(way, way[1:], strict=False))
        z = sum(np.exp(s) for s in ways.values())
        for i in range(n):
            for k in range(3):
                p = sum(np.exp(s) for w, s in ways.items() if w[i] == k) / z
                assert abs(found[start + i, k] - p) < 1e-9
        for w, s in ways.items():
            for a, b in zip(w, w[1:], strict=False):
                pairs[a, b] += np.exp(s) / z
        top = max(ways, key=ways.get)
        assert tuple(best[start : start + n]) == top
    assert np.allclose(pairs, expected)


def test_code_switched_words_get_their_own_language():
    texts = ["the house and the garden are green"] * 20 + ["das haus und der garten sind grün"] * 20
    model = language.fit(texts, ["en"] * 20 + ["de"] * 20)
    mixed = "the house and the garden are green. das haus und der garten sind grün."
    out = language.predict(pa.array([mixed, texts[0], None, "", "123 ..", "…"]), model).to_pylist()
    assert 0.3 < out[0]["score"] < 0.7
    assert out[1]["lang_pred"] == "en" and out[1]["score"] > 0.9
    assert [x["lang_pred"] for x in out[2:]] == ["und"] * 4


def test_disguised_insults_score_like_insults():
    words = "the of and house garden river stone winter letter morning sunday walking".split()
    random = np.random.default_rng(3)
    clean = [" ".join(random.choice(words, 30)) for _ in range(300)]
    toxic = [" ".join([*random.choice(words, 30), "blockhead"]) for _ in range(60)]
    clean = [f"{t} {i}" for i, t in enumerate(clean)]
    model = toxicity.fit(toxic + clean, [1] * 60 + [0] * 300)
    texts = ["you blockhead", "a block-head", "b l o c k h e a d", "blockxhead", "a quiet garden", "", None]
    x = toxicity.text_features(pa.array(texts), model, toxicity.Lookup(model.features))
    assert (x[:4, 1] > 0).all()
    assert (x[4:, 1] < 0).all()


def test_records_survive_any_chunking():
    rows = [(1, "u", "<p>é</p>", 1, False), (2, None, "<p>é</p>", 1, True), (None, "a\r\nb", None, None, False)]
    data = b"".join(warc.member(warc.record(*r)) for r in rows)
    for size in (1, 7, 1000, len(data)):
        chunks = (data[i : i + size] for i in range(0, len(data), size))
        got = [warc.parse(m) for m in warc.members(chunks)]
        assert [g["page_id"] for g in got] == [1, 2, None]
        assert [g["record_type"] for g in got] == ["response", "revisit", "response"]
        assert got[1]["refers_to"] == 1 and got[1]["payload_bytes"] == len("<p>é</p>".encode())
        assert got[0]["payload"].decode() == "<p>é</p>"
    with pytest.raises(ValueError):
        list(warc.members(iter([data[:-3]])))
    broken = warc.record(*rows[0]).replace("é".encode(), b"ab")
    with pytest.raises(ValueError):
        warc.parse(broken)


def test_many_pieces_of_length_one(spark):
    """Null and empty texts: their places are found by a search, whatever their number."""
    from pyspark.sql import functions as F

    from tidemark.llm.shared import settle

    n = 1_000_000
    length = F.when(F.col("id") % 10 == 0, 1 + F.pmod(F.xxhash64("id"), F.lit(300))).otherwise(1)
    pieces = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("key"), F.lit(0).alias("piece"),
        F.lit(0).cast("long").alias("start"), length.cast("long").alias("length"),
        F.lit(0).cast("long").alias("ids_crc32"),
    )
    packed = settle(packing.pack(settle(pieces, "pieces"), 512), "packed")
    ends = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("total"), F.max(F.col("offset") + F.col("length")).alias("end"),
        F.count_distinct("offset").alias("places"), F.count("*").alias("n"),
    )
    bad = ends.where("total <> end or places <> n or total > 512").count()
    total = packed.agg(F.sum("length")).first()[0]
    assert (packed.count(), bad) == (n, 0)
    assert ends.count() <= -(-total // 512) + 1
