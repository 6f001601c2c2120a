"""Text functions against plain-Python restatements of their rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as T

ALPHABET = "aZбЁё9 \t\n |.,-—!?\"')(é_[]"


def random_texts(n=300, seed=5):
    rng = random.Random(seed)
    return ["", " ", "a - b", "a|b", "...", "Да.", *["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 25))) for _ in range(n)]]


def run(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def squeeze(t):
    return re.sub(r"\s+", " ", t)


RULES = {
    "normalize_compare": (T.normalize_compare, lambda t: squeeze(re.sub(r"[^a-zа-яё0-9\s]", " ", t.lower())).strip()),
    "normalize_store": (T.normalize_store, lambda t: squeeze(re.sub(r"[\r\n|]", " ", t)).strip()),
    "clean_text": (T.clean_text, lambda t: re.sub(r" ([.,!?;:])", r"\1", squeeze(t)).replace(" - ", " — ").replace("|", " ").strip()),
    "is_boundary": (T.is_boundary, lambda t: bool(re.search(r"""[.!?…]+["')\]]*$""", t.strip()))),
    "punctuation_only": (T.punctuation_only, lambda t: bool(re.search(r"^[\W_]+$", t))),
    "tokens": (T.tokens, lambda t: t.split()),
    "non_printable": (lambda c: c.rlike(T.NON_PRINTABLE), lambda t: bool(re.search(r"[\x00-\x08\x0B\x0C\x0E-\x1F]", t))),
    "mode_share": (lambda c: T.mode_share(T.tokens(c), 2), lambda t: max(t.split().count(w) for w in t.split()) / len(t.split()) if len(t.split()) >= 2 else 0.0),
}


@pytest.mark.parametrize("name", sorted(RULES))
def test_rule(spark, name):
    column, rule = RULES[name]
    texts = random_texts()
    assert run(spark, column, texts) == [rule(t) for t in texts]


def test_control_characters_are_found(spark):
    assert run(spark, lambda c: c.rlike(T.NON_PRINTABLE), ["a\x07b", "a\tb", "a\x1fb"]) == [True, False, True]


def test_names(spark):
    assert run(spark, T.safe_out_name, ["  My file! ", "", "___", "a.wav"]) == ["My_file.wav", "utt.wav", "utt.wav", "a.wav"]
    assert run(spark, T.name_prefix, ["a_b_12.WAV", "a.wav"]) == ["a_b", None]
    assert run(spark, T.name_segment, ["a_b_12.WAV", "a.wav"]) == [12, None]


def test_raw_blocks(spark):
    assert run(spark, T.raw_blocks, ["I am [[ b ]] not [[c]]", "[[x]]", "y"]) == [["I am ", "[[ b ]]", " not ", "[[c]]"], ["[[x]]"], ["y"]]


def test_script_share_without_letters_is_null(spark):
    assert run(spark, T.script_share, ["да", "ab", "12", "дa"]) == [1.0, 0.0, None, 0.5]
