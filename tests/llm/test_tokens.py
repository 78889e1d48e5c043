"""Counts at prefixes, encoding, decoding and packed ids against the tokenizers' own libraries."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from screenlake.llm import packing, piece_matching, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(n, seed=3):
    r = random.Random(seed)
    units = ["a", "b", " ", "  ", "\n", "é", "é", "汉", "😀", "'s", "ing", "the", "<s>", "<|endoftext|>", "\0", "　", "\t", ".", ",", "1", "A", "İ", "ß", "_"]
    return ["", " ", "x" * 300, "tail ", " lead", "Word, word. word.,", *["".join(r.choice(units) for _ in range(r.randint(0, 40))) for _ in range(n)]]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_every_prefix(spark, library):
    texts = [t[:60] for t in odd_texts(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["prefix_counts"] for r in token_counts.prefix_table(docs, MODEL).collect()}
    fit = {r["doc_id"]: r["fit_chars"] for r in token_counts.with_counts(docs, MODEL, budget=7).collect()}
    for i, t in enumerate(texts):
        want = [len(library.encode(t[:k])) for k in range(len(t) + 1)]
        assert got[i] == want, t
        assert fit[i] == max(k for k, n in enumerate(want) if n <= 7), t


@pytest.mark.parametrize("unit", ["rare", "letters", "a", "internationalization", "digits"])
def test_long_text_without_blanks(library, unit):
    """200,000 characters in one run: exact, and in time linear in their number."""
    import time

    r = random.Random(5)
    text = {"rare": "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(200_000)), "letters": "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000)), "digits": "".join(r.choice("0123456789") for _ in range(200_000))}
    text = text.get(unit) or (unit * 200_000)[:200_000]
    counts, encoder = token_counts.PrefixCounts(MODEL), piece_matching.Encoder(MODEL)
    counts.measure(["warm up"], 10)
    began = time.process_time()
    found = counts.measure([text], 4096)
    took = time.process_time() - began
    want = library.encode(text)
    assert found[0][0] == len(want) and np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want
    print(unit, took)
    assert took < 6


def test_caches_are_bounded():
    from screenlake.llm import bpe

    cache = bpe.Cache(1000)
    for k in range(500):
        cache.put(f"key {k}", k)
    cache.put("x" * (bpe.LONGEST_KEPT + 1), 0)
    assert len(cache) + len(cache.old) <= 2 * (1000 // bpe.KEY_CHARS) and max(map(len, cache)) < 10
    assert cache["key 499"] == 499 and cache.get("key 0") is None


def test_longest_within():
    own = token_counts.PrefixCounts(MODEL)
    for t in odd_texts(40):
        counts = own.all_prefixes(t)
        for budget in (0, 1, 5, 12):
            assert own.longest_within(t, budget) == max(k for k, n in enumerate(counts) if n <= budget)


def test_encoded_and_decoded(spark, library):
    texts = odd_texts(400)
    docs = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    ids = piece_matching.encoded(docs, MODEL)
    got = {r["doc_id"]: r["ids"] for r in ids.collect()}
    back = {r["doc_id"]: r["text"] for r in piece_matching.decoded(ids, MODEL).collect()}
    for i, t in [*enumerate(texts), (-1, "")]:
        want = library.encode(t)
        assert got[i] == want and back[i] == library.decode(want), t


def test_packed_ids_are_the_tokenizers():
    path = public_tokenizers.path("word_bpe_49k.json")
    own = packing.Tokens(path)
    for seed in (1, 2):  # the second time parts are known already
        texts = odd_texts(600, seed)
        ids, begin = own.ids(pa.array([*texts, None]))
        for i, t in enumerate([*texts, ""]):
            assert ids[begin[i] : begin[i + 1]].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_marks_are_parts_of_their_own(monkeypatch):
    """A word isn't learned again with marks behind it, and ids stay the tokenizer's where marks must not be cut off: special tokens, letters that fall apart in lower case, marks that combine."""
    own = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    learned = []
    monkeypatch.setattr(own, "_learn", lambda new, f=own._learn: learned.extend(new) or f(new))
    own.ids(pa.array(["größe élan plain", "größe*** élan!!, plain%%% größe??"]))
    assert sorted(learned) == sorted(["größe", "élan", "plain", "***", "!!,", "%%%", "??"])
    odd = ["a<|endoftext|> b", "a|> b", "x\u0130, y", "e\u0301*** f", "a!\u0338 b", "it's' so", "x''s! y", "\u00d7!! \u00f7, z", "a!! b,b. c!", "n\u00a0! m", None, ""]
    ids, begin = own.ids(pa.array(odd))
    for i, t in enumerate(odd):
        assert ids[begin[i] : begin[i + 1]].tolist() == own.tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_wide_ids_survive(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in packing.sequences(docs, public_tokenizers.path("word_bpe_49k.json"), 1 << 20).collect()}
    assert got[2][0] == 1 and got[1][0] == 3
    import zlib

    assert got[2][1] == zlib.crc32(np.array([1 << 20], "<u4").tobytes())


def test_counts_of_whole_texts_keep_no_prefixes(monkeypatch):
    """Measuring asks for prefixes only of the chunks that a budget cuts, and says what the prefixes say."""
    own, plain = token_counts.PrefixCounts(MODEL), token_counts.PrefixCounts(MODEL)
    asked = []
    monkeypatch.setattr(own, "learn_inner", lambda chunks, f=own.learn_inner: asked.extend(chunks) or f(chunks))
    texts = ["", "one two three", "a\0b  c\n\nd ", "Ünïcödé 漢字かな🙂 x", "zq" * 700 + " end", "word " * 30, "x" * 1200 + "漢" * 20]
    for budget in (0, 3, 10, 10**6):
        asked.clear()
        want = [plain.all_prefixes(t) for t in texts]
        assert own.measure(texts, budget) == [(p[-1], max(i for i, n in enumerate(p) if n <= budget)) for p in want]
        assert len(asked) == sum(p[-1] > budget for p in want)


def test_arrow_memory_goes_back(monkeypatch):
    """Cut batches keep all rows, and after the last one the pool is asked to return what is free."""
    from types import SimpleNamespace

    import pyarrow as pa

    from screenlake.llm import common

    calls = []
    batch = pa.record_batch({"text": ["x" * 100] * 50})
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: calls.append(1)))
    cut = list(common.small_batches([batch, batch.slice(0, 0)], 1000))
    assert sum(map(len, cut)) == 50 and max(map(len, cut)) <= 10 and calls == [1]
