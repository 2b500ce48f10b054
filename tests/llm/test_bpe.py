import base64
import random

import pytest

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from array import array  # noqa: E402

from rootweave.llm import bpe  # noqa: E402

RANKS = P.path("byte_bpe_50k.tiktoken")
PARTS = [" ", "  ", "\n", "\t", "a", "the", "ing", "'s", "'ll", "é", "²", "日本", "\U0001F600", "\x1c", "\xa0", "_", "12", "!!", "...",
         "ß", "  \n", "I'd", "zzzz", " " * 90, "=" * 70, "a" * 2_000, "thethethe" * 300]


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library_and_decode_to_the_text(ranks, library):
    encoder, decoder, rng = bpe.Encoder(ranks, P.PATTERN), bpe.Decoder(ranks), random.Random(5)
    for _ in range(3_000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        ids = encoder.encode(text)
        assert array("I", ids).tolist() == library.encode_ordinary(text)
        assert decoder.decode(ids) == text


def test_any_two_tokens_stay_apart_as_merging_says(ranks, library):
    transducer, rng = bpe.Transducer(ranks), random.Random(6)
    for _ in range(5_000):
        a, b = rng.randrange(len(ranks)), rng.randrange(len(ranks))
        assert transducer.stays_apart(a, b) == (library._encode_single_piece(transducer.tokens[a] + transducer.tokens[b]) == [a, b])


def test_caches_that_overflow_do_not_change_results(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    monkeypatch.setattr(bpe, "PAIRS", 5)
    encoder = bpe.Encoder(ranks, P.PATTERN)
    text = "many unlikely wordings, manyfold and unwordlike; many unlikely ones " * 3
    assert array("I", encoder.encode(text)).tolist() == library.encode_ordinary(text)


def test_utf8_stream_is_the_incremental_decoder():
    rng = random.Random(7)
    for _ in range(5_000):
        data = bytes(rng.choice([rng.randint(0, 255), rng.randint(0xE0, 0xF5), rng.randint(0x80, 0xBF)]) for _ in range(rng.randint(0, 12)))
        stream = bpe.Utf8Stream()
        assert "".join(stream.feed(data[i : i + 1]) for i in range(len(data))) + stream.end() == data.decode("utf-8", "replace")


def test_frames(spark, odd, empty, library):
    rows = bpe.decode(bpe.encode(odd, RANKS, P.PATTERN), RANKS).collect()
    assert len(rows) == odd.count()
    for row in rows:
        expected = library.encode_ordinary(row["text"] or "")
        assert array("I", row["ids"]).tolist() == expected and row["n_tokens"] == len(expected)
        assert row["decoded"] == (row["text"] or "")
    assert bpe.decode(bpe.encode(empty, RANKS, P.PATTERN), RANKS).count() == 0


def test_checked_encoding_gives_the_same_ids(spark, odd):
    plain, checked = (bpe.encode(odd.select("doc_id", "text"), RANKS, P.PATTERN, check=c) for c in (False, True))
    assert sorted(map(str, checked.collect())) == sorted(map(str, plain.collect()))


def test_a_worker_that_goes_on_to_another_operator_gives_the_encoder_back(spark):
    from pyspark.sql import functions as F

    from rootweave.llm import common, jaccard

    ranks = {bytes([i]): i for i in range(256)}
    content = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    common.begin("bpe")
    bpe._encoder(content, P.PATTERN).encode("some text")
    bpe._decoder(content)
    common.begin("bpe")
    assert bpe._encoder.cache_info().currsize == bpe._decoder.cache_info().currsize == 1
    common.begin("toxicity")
    assert bpe._encoder.cache_info().currsize == bpe._decoder.cache_info().currsize == 0

    # In the workers of Spark: one partition, so one worker serves both jobs.
    docs = spark.range(3).select("id", F.lit("a b c d e f").alias("text")).coalesce(1)

    @F.udf("long")
    def left(_):
        return bpe._encoder.cache_info().currsize

    assert bpe.encode(docs, RANKS, P.PATTERN).agg(F.sum("n_tokens")).first()[0] > 0
    assert jaccard._hashes(docs, 5).select(left("_id").alias("n")).agg(F.max("n")).first()[0] == 0
