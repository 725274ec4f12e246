"""Documents with every odd case, and helpers for brute force."""

from __future__ import annotations

import random
import string

import pytest

pytest.importorskip("stakescope.llm")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BLANKS = " \t\n\x0b\x0c\r"


def words_of(text, lower=False):
    """Words between the six ASCII blanks."""
    text = text or ""
    for c in BLANKS:
        text = text.replace(c, " ")
    text = text.translate(LOWER) if lower else text
    return [w for w in text.split(" ") if w]


def alternating(n: int) -> tuple[str, str]:
    """The two complementary self-similar words of n letters: each letter by the parity of its place's binary ones."""
    word = "".join("ab"[k.bit_count() % 2] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def odd_texts(seed: int = 7) -> list[tuple[int | None, str | None]]:
    """(id, text): nulls, empty, short, long, copies, near copies, shared passages, runs, odd characters, specials."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßÄÖ") for _ in range(rng.randrange(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = prose(60), prose(120).split(" ")
    texts = [None, "", " \n\t ", "One", "one two three", "One two three", prose(40_000), "same " * 50, "same " * 12, "SAME same " * 30]
    texts += [" ".join(base)] * 3
    for k in range(12):
        near = list(base)
        for _ in range(k // 2):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        texts.append("  ".join(near))
    texts += [prose(20) + "\n" + passage + "\t" + prose(rng.randrange(30)) for _ in range(6)]
    texts += ["it's don't WE'LL they've 's 12 3½ ٣ <|endoftext|> x<|endoftext|>y", "日本語 テキスト 😀😀    a b", "a b\x85c\x1cd e", "'" * 9 + "s", "0777 77\r\n\r\n  x"]
    for word in alternating(1024):  # every polynomial hash in an odd radix gives both words the same value
        texts += [word, f"{word} one two three four", f"{word} " + " ".join(vocabulary[:14]), f"{word[:64]} " + " ".join(vocabulary[20:33])]
    texts += [prose(rng.randrange(1, 60)) for _ in range(20)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in rows] + [(None, passage)]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", "s", 0) for i, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return lambda name: (tokenizers.path(name), tokenizers.PATTERN)
