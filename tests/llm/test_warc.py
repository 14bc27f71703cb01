import io
import zipfile

import pytest
from pyarrow import fs

from granary.llm import warc
from granary.llm.common import folder_uri
from granary.llm.zipfiles import Writer, data_offset, directory


def reader(data):
    return (lambda at, n: data[at : at + n]), len(data)


def package(parts):
    out = io.BytesIO()
    w = Writer(out)
    for name, data in parts.items():
        w.begin(name)
        w.write(data[:3])
        w.write(data[3:])
        w.end()
    w.close()
    return out.getvalue()


def test_packages_are_valid_zip64_files():
    parts = {"archive/a": b"abcdef" * 9, "é/b": b""}
    data = package(parts)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == parts
    read, size = reader(data)
    for m in directory(read, size):
        assert data[data_offset(read, m) :][: m.size] == parts[m.name]


def test_packages_of_others_with_comment_and_plain_directory():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"PK\x05 not the end"
        z.writestr("x", b"hello")
        with z.open("y", "w", force_zip64=True) as f:
            f.write(b"world")
        z.writestr("z", b"packed" * 50, zipfile.ZIP_DEFLATED)
    read, size = reader(out.getvalue())
    found = {m.name: m for m in directory(read, size)}
    assert out.getvalue()[data_offset(read, found["y"]) :][:5] == b"world"
    with pytest.raises(ValueError):
        data_offset(read, found["z"])
    with pytest.raises(ValueError):
        directory(*reader(b"no zip file"))


def test_revisits_and_odd_rows(spark):
    long, short = "é" * 600, "x" * 999
    rows = [(1, "http://a/ü?x=1 2", long, 0), (3, None, long, 0), (2, "b", long, 0), (4, "", short, 0), (5, "c", short, 0), (6, "d", None, 0),
            (7, "e", "", 0), (3, None, long, 0), (None, "n", long, 0), (9, "big", "<p>" * 400_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = {(r.page_id, r.url): r for r in warc.round_trip(spark, df).collect()}
    assert len(warc.round_trip(spark, df).collect()) == len(rows)
    assert {k[0]: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), None: ("revisit", 3), 4: ("response", None), 5: ("response", None),
        6: ("response", None), 7: ("response", None), 9: ("response", None),
    }
    assert got[(1, "http://a/ü?x=1 2")].payload_bytes == 1200 and got[(6, "d")].payload_digest == "da39a3ee5e6b4b0d3255bfef95601890afd80709"
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_a_package_is_read_by_ranges(spark):
    folder = folder_uri(spark, "test")
    df = spark.createDataFrame([(i, "u", "y" * (2000 + i)) for i in range(200)], "page_id long, url string, html string")
    made = warc.write(df.coalesce(1), folder)
    (row,) = made.collect()
    assert row.records == 200 and fs.FileSystem.from_uri(folder)[0].get_file_info(row.package).size == row.bytes
    assert warc.ranges(made, folder).count() == -(-200 // warc.RUN)
    assert sorted(r.payload_bytes for r in warc.read(made, folder).collect()) == [2000 + i for i in range(200)]


def test_ids_beyond_doubles_beside_a_null(spark):
    long = "z" * 1200
    rows = [(2**60 + 1, "a", long), (2**60 + 3, "b", long), (None, "c", "short"), (2**60 + 2, "d", long), (None, "e", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.url: (r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(spark, df).collect()}
    assert got == {
        "a": (2**60 + 1, "revisit", 2**60 + 3), "b": (2**60 + 3, "response", None), "c": (None, "response", None),
        "d": (2**60 + 2, "revisit", 2**60 + 3), "e": (None, "revisit", 2**60 + 3),
    }
