import random
import zlib

import pytest
from pyspark.sql import functions as F

LONG = "a few words of a long text, and more. " * 3000
EDGE_ROWS = [
    (1, "A first text. It has two sentences, and some more words after them."),
    (2, None),
    (3, ""),
    (None, "a text without an id and with enough words to make shingles"),
    (5, "A first text. It has two sentences, and some more words after them."),
    (5, "A first text. It has two sentences, and some more words after them."),
    (7, LONG),
    (8, "x" * 5000),
    (9, "write to me.too@mail.example.com or call +1 (555) 555-0100, 10.0.0.1"),
    (10, "été <|endoftext|> \U0001f600    1234567890123456789012"),
]
# Names that operators use inside or in their results.
CLASHING = ("score", "shard", "slot", "spans", "ord", "crc", "class", "row", "key", "n", "starts", "counts", "kept", "toxic", "own", "digest", "doc", "h1", "h2", "name1", "own_id", "plain", "wide", "meta.src", "__own", "__pii_spans")


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = spark.createDataFrame(EDGE_ROWS, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0).cast("long")}
    )
    return rows.select("*", *[F.lit("?").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture
def write_tables(spark, tmp_path):
    """Write frames as tables of a folder, and give back the folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture(scope="session")
def one_checksum():
    """Two texts of one crc32: the first repeats a passage of 150 letters, the second nothing."""
    draw = random.Random(32)
    passage = "".join(draw.choice("abcdefghij") for _ in range(150))
    heads = {}
    for i in range(1 << 18):
        for kind, text in (("a", f"{passage} {i} {passage}"), ("b", f"{i} other words stand in this one, {i} of them")):
            crc = zlib.crc32(text.encode())
            if heads.get(crc, (kind, ""))[0] != kind:
                return sorted((text, heads[crc][1]), key=lambda t: passage not in t)
            heads[crc] = (kind, text)
    raise AssertionError("no two texts of one checksum")
