"""Token shards against direct encoding, keyed access, and odd inputs."""

import zlib

import numpy as np
import pytest

from loanloom.llm import token_files as tf
from loanloom.llm.storage import Scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = ["Hello world", "", None, " lead", "trail ", "two  spaces", "line\n next", "a \n\n b", "tab\there\t there", "x\n\ny",
         "don't can't 've", "<|endoftext|> end", "ünïcode \u00a0 wide\u3000 space", "0", "! ! !", "word " * 30_000]


def expected(rows):
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def read(spark, docs):
    shards = tf.write_shards(docs, Scratch(spark, "test"), PATH)
    rows = tf.with_starts(tf.read_documents(shards), shards).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    return shards, sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_ids_and_starts_match_direct_encoding(spark, monkeypatch):
    monkeypatch.setattr(tf, "SHARD_IDS", 64)
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(t, "clash", i) for i, t in rows], "text string, start string, doc_id bigint").repartition(3)
    _, got = read(spark, docs)
    assert got == expected(rows)


def test_repeated_and_missing_keys(spark):
    rows = [(None, "no key"), (5, "a"), (5, "a"), (5, "b"), (9, None)]
    _, got = read(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == expected(rows)


def test_empty_table(spark):
    shards, got = read(spark, spark.createDataFrame([], "doc_id bigint, text string"))
    assert got == [] and tf.lookup(shards, spark.range(3)).count() == 0


def test_keyed_lookup(spark, monkeypatch):
    rows = [(i * i, f"text {i} " * (i % 5)) for i in range(200)]
    shards, got = read(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    asked = spark.createDataFrame([(k,) for k in (0, 4, 5, 10_000, -3, 39_601, 99_999_999, None)], "k bigint")
    found = {r.doc_id: r.ids_crc32 for r in tf.lookup(shards, asked).collect()}
    assert found == {k: c for k, _, _, c in got if k in (0, 4, 10_000, 39_601)}


@pytest.mark.parametrize("n", [1, 2, 3, 50, 5_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).choice(10**15, n, replace=False) - 10**14
    seeds, slots = tf.build_index(keys)
    assert sorted(slots.tolist()) == list(range(n))
    prints = np.zeros(n, "<u4")
    prints[slots] = tf.fingerprint(keys)
    assert (tf.find(keys, seeds, prints) == slots).all()
    strange = keys + 10**16
    assert (tf.find(strange, seeds, prints) >= 0).sum() <= 1


def test_latin_words_go_to_the_model(monkeypatch):
    """Words of Latin letters are one piece and cost no text of their own; what else there is stays exact."""
    from tokenizers import Tokenizer

    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJÄÖÜßñéàøŁżªº"
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list(letters), rng.integers(1, 14))) for _ in range(400)]
    ends = ["", ",", ".", "!?", "...", "|"]
    latin = " ".join(w + ends[i % 6] for i, w in enumerate(words))
    odd = " ".join(f"{w}{x}" for w, x in zip(words, ["αβγ", "中文", "\u0250", "7", "'s", "\u00a0", "e\u0301", ".x", "\nNext.", "-", "<|endoftext|>"] * 30))
    direct, coder, asked = Tokenizer.from_file(PATH), tf.Encoder(PATH), []
    coder._word(""), coder._add({" " + w[1:] for w in (" ,", " .", " !?", " ...", " |")})
    add_words = coder._add_words
    monkeypatch.setattr(coder, "_add_words", lambda new: (asked.extend(x for x in new if x.strip().isalpha()), add_words(new)))
    for text in (latin, " " + latin, odd, latin + "\n" + odd):
        got = np.frombuffer(coder.encode([text])[0], coder.dtype).tolist()
        assert got == direct.encode(text, add_special_tokens=False).ids
        assert text is not latin or not asked


def test_lines_of_known_pieces_are_put_together_at_once(monkeypatch):
    """Letters and marks around a line end come from the model and the cache; nothing is left to be sorted out."""
    from tokenizers import Tokenizer

    direct, coder, left = Tokenizer.from_file(PATH), tf.Encoder(PATH), []
    coder.encode(["a, b. c!"])
    add_new = coder._add_new
    monkeypatch.setattr(coder, "_add_new", lambda rest: (left.extend(rest), add_new(rest)))
    for text in ("One, two.\nThree four!\nFünf six.", "two. Three\nOne,\nsix", "Seven.\neight nine"):
        assert np.frombuffer(coder.encode([text])[0], coder.dtype).tolist() == direct.encode(text, add_special_tokens=False).ids
    assert not left


def test_white_space_and_marks_stay_exact_when_parts_are_known(monkeypatch):
    """Parts kept from earlier texts never change a later one, also where the cache turns over."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(tf, "CACHE_ENTRIES", 40)
    rng, direct, coder = np.random.default_rng(3), Tokenizer.from_file(PATH), tf.Encoder(PATH)
    bits = ["a", "the", "Über", "中文", "αβγ", "7", "(279)", ")", "'s", "|", ",", "...", ".", "\n", "\t", " ", "　", " ", " ", " ", " ", "<|endoftext|>"]
    for _ in range(60):
        texts = ["".join(rng.choice(bits, rng.integers(0, 12))) for _ in range(50)]
        got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)]
        assert got == [direct.encode(x, add_special_tokens=False).ids for x in texts]
