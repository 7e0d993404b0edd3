"""Overlap resynchronisation of long texts; the agenda encoder needs no correction."""
import random

from tokenizers import Tokenizer

from ledgerflow.llm import sentencepiece_codec, token_counts
from ledgerflow.llm.common import read_documents, vocabulary

PATH = vocabulary("byte_bpe_50k.json")


def test_seams_of_random_texts():
    counter, library = token_counts.UnitCounter(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(8)
    parts = ["the", " the", "  ", " ", "\n", "\n\n ", "é", "日本語", "😀", "123", "'s", "don't", "<|endoftext|>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "x" * 70, ".", "\t", "　"]
    widened = 0
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 120)))
        for chunk, overlap in ((40, 8), (64, 3), (7, 1)):
            n, chunks, more = counter.spliced(text, chunk, overlap)
            assert n == len(library.encode(text, add_special_tokens=False).ids), (text, chunk, overlap)
            assert chunks >= 1
            widened += more
    assert widened


def test_a_run_without_spaces_widens_to_the_end():
    counter, library = token_counts.UnitCounter(PATH), Tokenizer.from_file(PATH)
    for text in ("a" * 5000, "word " * 50 + "b" * 3000 + " word" * 500, " " * 3000):
        n, chunks, widened = counter.spliced(text, 200, 20)
        assert n == len(library.encode(text, add_special_tokens=False).ids) and widened


def test_seam_compares_the_tokens():
    counter = token_counts.UnitCounter(PATH)
    text = "one two three four five six seven"
    left, right = counter.chunk(text, 0, 24), counter.chunk(text, 5, len(text))
    at = counter.seam(text, left, right, 5, 24)
    assert at is not None and text[at[2]] == " " and left[1].ids[at[0]] == right[1].ids[at[1]]
    other = counter.chunk("x" * 5 + "abc def ghijk lmno pqrs tuv wxyzab", 5, len(text))       # other tokens are no seam
    assert counter.seam(text, left, other, 5, 24) is None


def test_agenda_is_never_corrected(spark):
    found = sentencepiece_codec.encode_decode(read_documents(spark, "/root/testdata/sf0.001"))
    assert found.filter("n_corrected > 0").count() == 0
