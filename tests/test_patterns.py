import random

import pytest
import regex
from pyspark.sql import functions as F

from veilframe.config import Masking, Pattern
from veilframe.functions import ciphers, masking, values
from veilframe.functions.patterns import to_java


def column(spark, cells, change):
    df = spark.createDataFrame(list(enumerate(cells)), "i int, v string")
    return [r.v for r in df.select("i", change(F.col("v")).alias("v")).orderBy("i").collect()]


def plan(spark, change):
    return spark.createDataFrame([("a",)], "v string").select(change(F.col("v")).alias("v"))._jdf.queryExecution().executedPlan().toString()


def masked(**e):
    return lambda c: masking.mask(c, Masking("v", patterns=(Pattern("*", **e),)))


@pytest.mark.parametrize(
    "source, least, most",
    [("abc", 3, 3), ("a|bcd", 1, 3), ("(a+)(?:b?)c{2,4}", 3, 1 << 30), ("a*", 0, 1 << 30), (r"^\d{3}$", 3, 3), ("(?=ab)c", 1, 1), ("(a|)b", 1, 2), (r"(a)\1", 1, 1 << 30), ("[a-z&&[^aeiou]]", 1, 1), ("", 0, 0), ("(?i)ab|c", 1, 2)],
)
def test_widths(source, least, most):
    found = to_java(source)
    assert (found.least, min(found.most, 1 << 30)) == (least, most)


@pytest.mark.parametrize("source", ["(", "a)", "[a", "a{2,1}", "*a", r"\q", "(?P<a>x)(?P<a>y)", r"\p{Nonsense}", "[z-a]", "(?<=a+)b", r"\2(a)", "(?x) a", "[[:nope:]]", "a{1001}", "(?P<n", "a\\"])
def test_what_is_no_pattern(source):
    assert to_java(source) is None


SOURCES = [
    r"(?P<no>[0-9])", r"\p{Lu}+", "[[:digit:]]+", "[0-9]+", r"[a-z]+\d", r"(?i)straße|ab", r"\bw\w*\b", r"[^a-z\s]+", r"x|yy|zzz", r"(?P<a_b>a)(?P=a_b)", r"[\p{L}&&[^a-c]]+",
    r".+?(?=@)", r"(?<=@).+$", r"^.{2}", r"[\]\[\-^]+", r"\x41|\u{42}|C", r"[[:upper:][:digit:]]{2}", r"(?s)a.b", r"a\.b", r"[a\-z]", r"\s+", r"(?m)^a", r"(?:ab)+c?", r"\PL+", r"(?i:b)B", r"[^[:alpha:]]",
]


@pytest.mark.parametrize("source", SOURCES)
def test_masks_in_expressions_as_python_does(spark, source):
    rnd = random.Random(1)
    letters = ["a", "b", "c", "A", "B", "C", "w", "x", "y", "z", "1", "٣", "é", "ß", "S", "@", ".", " ", "-", "[", "]", "\n", "日", "𝒳", "^", "_"]
    cells = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) + "!" for _ in range(300)] + ["a\nb", "Straße ab", "aa", "STRASSE", "ab1@c"]
    change = masked(regex=source)
    assert "ArrowEvalPython" not in plan(spark, change)
    ascii_ = source.replace("[:digit:]", "0-9").replace("[:upper:]", "A-Z").replace("[:alpha:]", "A-Za-z").replace(r"\u{42}", "B")
    flags = regex.V1 if "&&" in source else 0
    own = regex.compile(ascii_.replace("$", r"\Z"), flags)
    assert column(spark, cells, change) == [own.sub(lambda m: "*" * len(m[0]), x) for x in cells]


@pytest.mark.parametrize("source, groups", [(r"(\w+)@(\w+)", ((1, "partial"), (2, "full"))), (r"(a)|(b+)", ((1, "full"), (2, "partial"), (9, "full"))), (r"(?P<x>[0-9]{1,2})-?", ((1, "full"),)), (r"(a(b))c", ((1, "partial"), (2, "full"))), ("ab", ((0, "partial"), (1, "full"))), (r"(.)(.)(.)", ((2, "full"), (1, "full"), (3, "odd")))])
def test_groups_in_expressions_as_text_by_text(spark, source, groups):
    rnd = random.Random(2)
    cells = ["".join(rnd.choice("aabbc1-@ 𝒳") for _ in range(rnd.randint(1, 20))) + "!" for _ in range(200)] + ["ab@ab"]
    change = masked(regex=source, groups=groups)
    assert "ArrowEvalPython" not in plan(spark, change)
    own = regex.compile(source)
    assert column(spark, cells, change) == [own.sub(lambda m: masking.groups_masked(m, groups, "*"), x) for x in cells]


def beside(text, after, delimiter, length):
    out, at = list(text), text.find(delimiter)
    while at >= 0:
        end = at + len(delimiter)
        for i in range(end, min(end + length, len(out))) if after else range(max(0, at - length), at):
            out[i] = "*"
        at = text.find(delimiter, end)
    return "".join(out)


@pytest.mark.parametrize("kind", ["before", "after"])
@pytest.mark.parametrize("delimiter, length", [("@", 2), ("ab", 1), ("aa", 1), ("aba", 4), ("$.", 3), ("\\", 1), ("𝒳", 2)])
def test_beside_delimiters(spark, kind, delimiter, length):
    rnd = random.Random(3)
    cells = ["".join(rnd.choice(["a", "b", "@", "$", ".", "\\", "𝒳", "\n"]) for _ in range(rnd.randint(1, 20))) + "!" for _ in range(300)]
    change = lambda c: values.mask_beside(c, kind == "after", delimiter, length)
    assert "ArrowEvalPython" not in plan(spark, masked(type=kind, delimiter=delimiter, length=length))
    assert column(spark, cells, change) == [beside(x, kind == "after", delimiter, length) for x in cells]


def test_mask_characters_are_taken_as_they_are(spark):
    for char in "$\\.":
        change = lambda c, char=char: masking.mask(c, Masking("v", patterns=(Pattern(char, regex="[0-9]+"), Pattern(char, regex="ab"), Pattern(char, type="after", delimiter="@", length=1))))
        assert column(spark, ["a1b22ab@x"], change) == [f"a{char}b{char * 2}{char * 2}@{char}"]


def test_patterns_that_may_match_nothing_go_text_by_text(spark):
    assert "ArrowEvalPython" in plan(spark, masked(regex="a*"))
    assert column(spark, ["abab", "b"], masked(regex="a*")) == ["*b*b", "b"]


def test_batches_of_the_cipher_are_the_cipher():
    rnd = random.Random(4)
    key = b"k" * 16
    for alphabet in (values.DIGITS, values.UPPER, values.LOWER):
        for n in (0, 1, 2, 3, 5, 8, 19, 60):
            texts = ["".join(rnd.choice(alphabet) for _ in range(n)) for _ in range(25)]
            hidden = ciphers.fpe_batch(key, texts, alphabet)
            assert hidden == [ciphers.fpe_encrypt(key, t, alphabet) for t in texts]
            assert ciphers.fpe_batch(key, hidden, alphabet, decrypt=True) == texts
    words = ["ABCDE1234F", "no pan", "12345", "", "٣", "aB1-9 x", "ABCDE1234F"]
    for parts, one in ((ciphers.pan_parts, ciphers.fpe_pan), (ciphers.digit_parts, ciphers.fpe_digits)):
        assert ciphers.changed(words, "m", parts) == [one(w, "m") for w in words]
    assert ciphers.changed(words, "m", ciphers.general_parts("c")) == [ciphers.fpe_general(w, "m", "c") for w in words]


@pytest.mark.parametrize("key", ["00112233445566778899aabbccddeeff", "long " * 40])
def test_keystream_in_expressions(spark, key):
    cells = ["a", "hello", "é日𝒳", "x" * 15, "y" * 16, "z" * 17, "long " * 50, "past the plan " * 200, None, "", "nan"]
    change = lambda c: ciphers.xor_column(c, key, "col")
    assert "Python" not in plan(spark, change)
    hidden = column(spark, cells, change)
    assert hidden == [x if x in (None, "", "nan") else ciphers.xor_encrypt(x, key, "col") for x in cells]
    assert column(spark, hidden, lambda c: ciphers.xor_column(c, key, "col", decrypt=True)) == cells
