import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null, empty and very long texts, ties, repeated rows, odd characters,
    null keys, and extra columns whose names clash with likely internal ones."""
    base = "one two three four five six seven eight nine ten"
    long = " ".join(f"w{i % 700}x{i}" for i in range(30000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (4, base, "en", None),
        (5, base, "en", "b"), (5, base, "en", "b"), (6, "word", "de", "b"), (7, long, "en", "a"),
        (8, "über 😀 ñandú " * 30, "es", "c"), (9, (base + "\n") * 12, "en", "a"),
        (None, "no id here " * 30, "en", "a"), (10, long + " tail", "en", "a"),
        (11, "mail a.b+c@d-e.example.org or 4111 1111 1111 1111, +1 (415) 555-0199, 10.0.0.255, 1.2.3.256", "en", "z"),
        (12, "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 but not DE89370400440532013001", "de", "z"),
        (13, "a@b.c%d@e.f 1.2.3.4.5.6.7.8 4111-1111-1111-1112 +12 x@y +1+2345678901 ssn 123-45-6789", "en", "z"),
        (14, "\x1f odd space and \x0b tabs\r\nhere " * 9, "fr", "z"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F
    return df.withColumns({"n_chars": F.length("text").cast("long"), "size": F.lit("x"), "h": F.lit(1),
                           "row": F.lit(2), "score": F.lit("s"), "seg": F.lit(0), "tie": F.lit("t")})


@pytest.fixture()
def write_docs(tmp_path):
    """Write a frame as <dir>/documents.parquet and return the dir."""
    def write(df, name="documents"):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
