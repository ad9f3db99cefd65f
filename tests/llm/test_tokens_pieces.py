"""Token counts and pieces against the libraries that own the vocabulary files."""

import random
from array import array

import pytest

from strandseek.llm.pieces import MARK, UNIGRAM, Model, decode_pieces, encode_pieces, model, round_trips
from strandseek.llm.tokens import MergeCounter, token_counts

P = pytest.importorskip("public_tokenizers")
TEXTS = ["", " ", "   lead", "the cat isn't 12,345 <|endoftext|> x", "<|endoftext|>", "é日本語 😀  \x1c\x85", "a" * 3000, "ab " * 500, "\n\n\t x'LL y'll", "▁▁ x", "x\x00y"]


def scrambled(n, seed):
    rng = random.Random(seed)
    signs = "ab the▁ \t\n  éñ日本1239.,!?'\"-_<s>😀ing tioń"
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_counts_are_the_librarys():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    texts = TEXTS + scrambled(500, 1)
    count = MergeCounter(path)
    assert [count(x) for x in texts] == [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_every_character_is_cut_alike():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}!b" for c in points]
    count = MergeCounter(path)
    assert [count(x) for x in texts] == [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_pieces_are_the_librarys():
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    library, texts = sentencepiece.SentencePieceProcessor(model_file=path), TEXTS + scrambled(800, 2)
    m = model(path)
    for text, ids in zip(texts, m.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text), text
        assert m.decode(ids.tolist()) == library.decode(ids.tolist()) == text.replace(MARK, " ")


def test_unigram_viterbi():
    """With scores as a unigram model has them, a word's pieces have the best sum of all its segmentations."""
    m = Model(P.path("piece_bpe_32k.model"))
    m.kind = UNIGRAM
    rng = random.Random(4)
    words = sorted({MARK + "".join(rng.choice("thecainsor") for _ in range(rng.randrange(1, 9))) for _ in range(60)} | {"x", MARK + "the", MARK + "then"})

    def best(word):
        if not word:
            return 0.0
        return max(m.score[m.ids[word[:k]]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in m.ids)

    found = m.learn_words(words)
    for word in words:
        ids = array("i", found[word])
        assert "".join(m.text_of[k] for k in ids) == word
        assert sum(m.score[k] for k in ids) == pytest.approx(best(word))


def test_frames(spark):
    rows = [(1, "the cat", "x"), (1, "the cat", "x"), (None, None, None), (2, "", "y"), (3, "word " * 600, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(docs, P.path("byte_bpe_50k.json")).collect()))
    assert got == [(0, 0, 0, False), (1, 7, 2, False), (1, 7, 2, False), (2, 0, 0, False), (3, 3000, 601, True)]
    path = P.path("piece_bpe_32k.model")
    pieces = {r["doc_id"]: r["pieces"] for r in encode_pieces(docs, path).collect()}
    assert pieces[None] is None and pieces[2] == [] and len(pieces[3]) > 600
    back = encode_pieces(docs, path).select("doc_id", decode_pieces("pieces", path).alias("t")).collect()
    assert {(r["doc_id"], r["t"]) for r in back} == {(r[0], r[1]) for r in rows}
    assert all(r["round_trip"] for r in round_trips(docs, path).collect())
    assert token_counts(docs.limit(0), P.path("byte_bpe_50k.json")).count() == encode_pieces(docs.limit(0), path).count() == 0
