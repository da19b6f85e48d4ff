import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veilframe.config import Masking, Pattern
from veilframe.functions import ciphers, masking, values

HEX = bytes.fromhex("00112233445566778899aabbccddeeff")
VECTORS = [
    (b"foo", values.DIGITS, "123456", "979962"),
    (b"foo", values.DIGITS, "000001", "897283"),
    (b"foo", values.UPPER + values.DIGITS, "ABCDE1234F", "LQOZ1T7HUQ"),
    (HEX, values.DIGITS, "9876543210", "9926847934"),
    (HEX, values.UPPER, "ABCDE", "TOBFD"),
]


@pytest.mark.parametrize(("key", "alphabet", "plain", "hidden"), VECTORS)
def test_cipher_vectors(key, alphabet, plain, hidden):
    assert ciphers.fpe_encrypt(key, plain, alphabet) == hidden
    assert ciphers.fpe_decrypt(key, hidden, alphabet) == plain


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet=values.DIGITS + values.UPPER + values.LOWER + "-é ", max_size=40), st.binary(min_size=1, max_size=16))
def test_ciphers_come_back(text, key):
    master = key.hex()
    hidden = ciphers.fpe_general(text, master, "c")
    assert ciphers.fpe_general(hidden, master, "c", ciphers.fpe_decrypt) == text
    assert re.sub("[0-9]", "0", re.sub("[A-Z]", "X", re.sub("[a-z]", "x", hidden))) == re.sub("[0-9]", "0", re.sub("[A-Z]", "X", re.sub("[a-z]", "x", text)))
    assert ciphers.xor_decrypt(ciphers.xor_encrypt(text, master, "c"), master, "c") == text


def test_cipher_edges():
    assert ciphers.fpe_encrypt(b"k", "", values.DIGITS) == ""
    assert "".join(ciphers.fpe_encrypt(HEX, d, values.DIGITS) for d in values.DIGITS) == "7890123456"
    with pytest.raises(ValueError):
        ciphers.fpe_encrypt(b"k", "12a", values.DIGITS)
    with pytest.raises(ValueError):
        ciphers.fpe_encrypt(b"k", "11", "1")
    assert ciphers.unchecked(ciphers.fpe_encrypt, b"k", "12a", values.DIGITS) == "12a"
    assert ciphers.fpe_pan("abc", "k") == "abc" and ciphers.fpe_digits("12x", "k") == "12x" and ciphers.fpe_digits("", "k") == ""
    assert ciphers.fpe_digits("٣٤", "k") == "٣٤"


def column(spark, cells, change):
    df = spark.createDataFrame(list(enumerate(cells)), "i int, v string")
    return [r.v for r in df.select("i", change(F.col("v")).alias("v")).orderBy("i").collect()]


def test_missing_values_pass_every_transform(spark):
    odd = [None, "", "  ", "NaN", "nan", " nAn\t"]
    entries = Masking("v", positions=(1,), class_mode="fixed_class")
    for change in (values.hash_hex, lambda c: values.salted_hash_hex(c, "ab"), values.cloak, lambda c: masking.mask(c, entries), lambda c: ciphers.pan_column(c, "k"), lambda c: ciphers.digits_column(c, "k"), lambda c: ciphers.general_column(c, "k", "v"), lambda c: ciphers.xor_column(c, "k", "v")):
        assert column(spark, odd, change) == odd


def test_numbers(spark):
    cells = ["5", " 5 ", "1e3", ".5", "-2.5", "+7.", "5d", "5f", "abc", "", None, "nan", "inf", "1e999", "0x1"]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, v string")
    got = [r.n for r in df.select("i", values.number(F.col("v")).alias("n")).orderBy("i").collect()]
    assert got == [5, 5, 1000, 0.5, -2.5, 7] + [None] * 9


def test_masks(spark):
    m = lambda **e: lambda c: masking.mask(c, Masking("v", **e))
    p = lambda **e: m(patterns=(Pattern("*", **e),))
    assert column(spark, ["abcdef", "a", "é日x"], m(positions=(1, 3, 99))) == ["*b*def", "*", "*日*"]
    assert column(spark, ["aB3-9"], m(class_mode="fixed_class")) == ["XX0-0"]
    assert column(spark, ["a@bcd", "a@b@cdef", "x"], p(type="after", delimiter="@", length=2)) == ["a@**d", "a@****ef", "x"]
    assert column(spark, ["abc@d"], p(type="before", delimiter="@", length=2)) == ["a**@d"]
    assert column(spark, ["@abc", "john@x.com"], p(type="before", delimiter="@", length=5)) == ["@abc", "****@x.com"]
    assert column(spark, ["john@mail", "no match", "aa@aa"], p(regex=r"(\w+)@(\w+)", groups=((1, "partial"), (2, "full")))) == ["j***@****", "no match", "a*@**"]
    assert column(spark, ["john@x.com", "none"], p(type="before", delimiter="@")) == ["****@x.com", "none"]
    assert column(spark, ["a.b(c)d", "x y z", "xyz"], p(type="in_between", start="(", end=")")) == ["a.b(*)d", "x ***", "xyz"]
    assert column(spark, ["ab:cd"], p(type="in_between", start=":", end="$")) == ["ab:**"]
    assert column(spark, ["a1٣b"], p(regex=r"\d")) == ["a**b"]
    assert column(spark, ["abab", "b"], p(regex="a*")) == ["*b*b", "b"]
    assert column(spark, ["ab"], p(regex="(")) == ["ab"]
    assert column(spark, ["john@x.com"], lambda c: masking.mask(c, Masking("v", patterns=(Pattern("*", type="before", delimiter="@"),)), derived=False)) == ["john@x.com"]
    assert column(spark, ["ab12"], m(class_mode="fixed_class", class_digit="a", class_letter="9")) == ["99aa"]


def test_cloak_keeps_kinds_and_varies(spark):
    cells = ["Ab3-é"] * 50
    got = column(spark, cells, values.cloak)
    assert all(re.fullmatch(r"[A-Z][a-z][0-9]-é", x) for x in got)
    assert len(set(got)) > 20


def test_literal_regex_against_python(spark):
    rng = random.Random(1)
    cells = ["".join(rng.choice("ab1 -Z") for _ in range(rng.randint(1, 30))) + "x" for _ in range(200)]
    for pattern in ("[a-z]+", "b1|1b", "^.", "[0-9 ]{2}"):
        got = column(spark, cells, lambda c: values.mask_regex(c, pattern, "*"))
        assert got == [re.sub(pattern, lambda m: "*" * len(m[0]), x) for x in cells]


def test_registered_functions(spark):
    ciphers.register(spark)
    row = spark.sql("select fpe_digits('123456', 'k') a, xor_decrypt(xor_encrypt('hello', 'k', 'c'), 'k', 'c') b, fpe_pan('ABCDE1234F', 'k') c").first()
    assert row.a == ciphers.fpe_digits("123456", "k") and row.b == "hello" and row.c == ciphers.fpe_pan("ABCDE1234F", "k")


def test_rounds_of_a_batch_are_worked_out_together(monkeypatch):
    """Ciphertexts are those of the plain cipher, and no half of many places is turned into digits on its own."""
    rng, key = random.Random(9), ciphers.derive_key("k", "c")
    cases = []
    for alphabet in (values.DIGITS, values.UPPER, values.LOWER):
        for n in (12, 19, 25, 69, 97, 200):
            texts = ["".join(rng.choice(alphabet) for _ in range(n)) for _ in range(20)]
            cases.append((key, alphabet, texts, [ciphers.fpe_encrypt(key, t, alphabet) for t in texts]))
    texts = [f"{rng.randrange(10_000):04}" for _ in range(500)]
    cases.append((b"z" * 100, values.DIGITS, texts, [ciphers.fpe_encrypt(b"z" * 100, t, values.DIGITS) for t in texts]))
    monkeypatch.setattr(ciphers, "_digits", None)
    for k, alphabet, plain, hidden in cases:
        assert ciphers.fpe_batch(k, plain, alphabet) == hidden
        assert ciphers.fpe_batch(k, hidden, alphabet, decrypt=True) == plain
