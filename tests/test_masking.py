import hashlib

import pytest
from pyspark.sql import functions as F

from carelake import fixed_values as fx
from carelake.functions import masking
from carelake.operators import cleaning


def test_techniques(people):
    first = cleaning.mask_sensitive(people, "secret").where(F.col("blood_pressure") == "130/85").first()
    digest = hashlib.sha256("Ana Souza".encode()).hexdigest()
    assert first["cpf"] == "***456***"
    assert first["nome"] == f"A***_{digest[:6]}"
    assert first["email"] == "A***@mail.example"
    assert first["telefone"] == "(**) *****-5678"
    assert first["patient_id"] == hashlib.sha256(b"PAC-100001secret").hexdigest()
    assert first["cidade"] == "Recife"


@pytest.mark.parametrize("column", [*fx.SENSITIVE_FIELDS, "medical_record_number", "anything"])
def test_null_stays_null_and_equal_stays_equal(spark, column):
    df = spark.createDataFrame([("abc@def",), ("abc@def",), (None,)], f"{column} string")
    masked = [r[0] for r in cleaning.mask_column(df, column, "k").collect()]
    assert masked[0] == masked[1] and masked[0] not in (None, "abc@def")
    assert masked[2] is None


def test_email_edges(spark):
    cases = {"no-at-sign": None, "a@b@c": "a***@b", "@x": "@***@x", "a@": "a***@"}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r[0]: r[1] for r in df.select("v", masking.mask_email(F.col("v"))).collect()} == cases


def test_generic_edges(spark):
    cases = {"ab": "ab", "abc": "abc***", "abcdef": "abc***", "": "", "abcd\nxyz": "abc***\nxyz"}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r[0]: r[1] for r in df.select("v", masking.mask_generic(F.col("v"))).collect()} == cases
    strict = {r[0]: r[1] for r in df.select("v", masking.mask_generic(F.col("v"), strict=True)).collect()}
    assert strict["ab"] == "***" and strict["abcdef"] == "abc***"


def test_generic_takes_numbers_and_absent_columns_pass(spark):
    df = spark.createDataFrame([(12345,)], "n int")
    assert cleaning.mask_column(df, "n", "k").first()[0] == "123***"
    assert cleaning.mask_column(df, "cpf", "k").columns == ["n"]


def test_key_changes_the_hash(spark):
    df = spark.createDataFrame([("p",)], "patient_id string")
    one, two = (cleaning.mask_column(df, "patient_id", k).first()[0] for k in ("a", "b"))
    assert one != two and len(one) == 64


def test_hmac_equals_published_vectors(spark):
    """RFC 4231, cases 1, 2 and 6, and the null value."""
    cases = [
        (b"\x0b" * 20, "Hi There", "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
        (b"Jefe", "what do ya want for nothing?", "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
        (b"\xaa" * 131, "Test Using Larger Than Block-Size Key - Hash Key First", "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
    ]
    for key, text, digest in cases:
        assert spark.range(1).select(masking.hmac_hash(F.lit(text), key)).first()[0] == digest
    assert spark.range(1).select(masking.hmac_hash(F.lit(None).cast("string"), "k")).first()[0] is None
