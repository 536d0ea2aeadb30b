import random
import re

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, spans string, kept string"

#: Null ids and texts, empty and blank texts, repeated ids and rows, ties, other scripts.
ODD = [
    (1, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (2, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (2, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (3, None),
    (4, ""),
    (5, " \t\n\x0b\x0c\r "),
    (6, "one"),
    (6, "another text with this id, Größe and ÉCOLE   no-break"),
    (None, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (None, None),
    (7, "la " * 5000),
    (8, "ab cd " * 4000 + "\nab cd\nab cd\n"),
    (9, "x #*$%&|<> y\r\nx\n\nx\n" + "zwölf Boxkämpfer jagen " * 30),
    (10, "<|endoftext|> 's 't   three   spaces \n \n  end  "),
    (11, "Z" * 100_000),
    (-5, "A B C D E F G H I J K L M N O P Q R S T U V W X Y Z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, None if k % 3 else "en", None if k % 4 else "src", len(t or ""), "n", "s", "k") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def babble(seed, n_docs, words, alphabet):
    """Documents over few words, so that much repeats; every third copies from another."""
    rng = random.Random(seed)
    docs = []
    for i in range(n_docs):
        own = [rng.choice(alphabet) for _ in range(rng.randrange(words))]
        if docs and i % 3 == 0:
            other = rng.choice(docs)[1].split()
            a = rng.randrange(len(other) + 1)
            own[rng.randrange(len(own) + 1) : 0] = other[a : a + 40]
        docs.append((rng.randrange(10 * n_docs), rng.choice([" ", "\n", "  "]).join(own)))
    return docs


def thue_morse(n, a, b):
    """The sequence and its complement: any polynomial modulo 2**64 names both alike from 1024 values on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [(a, b)[x] for x in bits], [(b, a)[x] for x in bits]
