"""One JSON document split among tasks: every border, every cut, what is damaged."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from strata.sources import CORRUPT_COLUMN, json_array, read_json_array

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("s", T.StringType()),
                       T.StructField("o", T.StructType([T.StructField("x", T.ArrayType(T.LongType()))]))])
RECORDS = [{"a": 1, "s": "}{][,\"", "o": {"x": [1, 2]}}, {"a": 2, "s": "\\", "o": None}, {"a": 3, "s": "\\\"{", "o": {"x": []}},
           {}, {"a": 4, "s": "× é ✓ \\\\}", "o": {"x": [3]}}, {"a": 5, "s": "{" * 9}]
NASTY = json.dumps(RECORDS, indent=1, ensure_ascii=False) + "\n"


def _batches(text: bytes, size: int, rows: int = 3, states=None):
    """The pieces of ``text`` as the text source hands them out in blocks of ``size`` bytes."""
    pieces, at = [], 0
    for piece in text.split(b"{"):
        pieces.append(((max(at - 1, 0) // size) * size if at else 0, piece))
        at += len(piece) + 1
    for i in range(0, len(pieces), rows):
        block, piece = zip(*pieces[i:i + rows])
        names, columns = ["file", "block", "piece"], [pa.array([7] * len(piece)), pa.array(block), pa.array(piece, pa.binary())]
        for j, name in enumerate(("inside", "depth", "base")):
            if states is not None:
                names.append(name)
                columns.append(pa.array([states[b][j] for b in block]))
        yield pa.RecordBatch.from_arrays(columns, names)


def _records(text: bytes, size: int):
    """All whole records by the two passes, without Spark."""
    blocks = sorted((b["block"], b) for x in json_array._summaries(_batches(text, size)) for b in x.to_pylist())
    states, inside, depth = {}, 0, 0
    base = int(next((b["opening"] for _, b in blocks if b["opening"]), "") == "[")
    for at, b in blocks:
        states[at] = (inside, depth, base)
        depth += b["depth_inside"] if inside else b["depth_outside"]
        inside = (inside + b["quotes"]) % 2
    out, open_piece = [], b""
    for x in json_array._cut(_batches(text, size, 2, states)):
        for r in x.to_pylist():
            if r["part"] is None:
                out.append(r["text"])
            else:
                open_piece += r["text"]
                if r["closed"]:
                    out.append(json_array._record(open_piece, base)[1])
                    open_piece = b""
    return out, open_piece


@pytest.mark.parametrize("text", [NASTY, json.dumps(RECORDS), "\n".join(map(json.dumps, RECORDS)), json.dumps(RECORDS[0], indent=3)])
def test_blocks_end_at_every_byte(text):
    raw = text.encode()
    want = json.loads(text) if text[0] == "[" else [json.loads(x) for x in (text.split("\n") if "\n " not in text else [text])]
    for size in range(1, len(raw) + 2):
        got, rest = _records(raw, size)
        assert [json.loads(x) for x in got] == want
        assert rest.strip() == (b"]" if text[0] == "[" else b"")


def _write(folder, text):
    path = os.path.join(folder, f"doc{len(os.listdir(folder))}.json")
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())
    return path


def _rows(df):
    return sorted((json.dumps(r.asDict(True), sort_keys=True) for r in df.collect()))


def test_split_read_equals_whole_read(spark, tmp_root):
    path = _write(tmp_root, NASTY)
    whole = _rows(spark.read.schema(SCHEMA).option("multiLine", True).json(path))
    for size in (1, 13, 64, None):
        assert _rows(read_json_array(spark, path, SCHEMA, split_bytes=size)) == whole
    assert len(whole) == len(RECORDS)


def test_many_files_and_empty_ones(spark, tmp_root):
    texts = [NASTY, "", "[]", " [ \n ] ", json.dumps(RECORDS[0]), "\n".join(map(json.dumps, RECORDS[:2])) + "\n"]
    for t in texts:
        _write(tmp_root, t)
    df = read_json_array(spark, tmp_root, SCHEMA, keep_corrupt=True, split_bytes=40, file_col="name")
    rows = df.collect()
    assert all(r[CORRUPT_COLUMN] is None for r in rows)
    count = {os.path.basename(r.name): sum(x.name == r.name for x in rows) for r in rows}
    assert count == {"doc0.json": 6, "doc4.json": 1, "doc5.json": 2}
    spark_conf = spark.conf.get("spark.sql.files.openCostInBytes")
    assert spark_conf != "0b"  # the setting of the read is gone again


def test_cut_off_documents_raise(spark, tmp_root):
    raw = json.dumps(RECORDS[:3]).encode()
    for i in range(1, len(raw)):
        _write(tmp_root, raw[:i])
    rows = read_json_array(spark, tmp_root, SCHEMA, keep_corrupt=True, split_bytes=16, file_col="name").collect()
    damaged = {r.name for r in rows if r[CORRUPT_COLUMN] is not None}
    assert len(damaged) == len(raw) - 1  # every cut is told
    whole = [r for r in rows if r[CORRUPT_COLUMN] is None]
    assert {(r.a, r.s) for r in whole} == {(x["a"], x["s"]) for x in RECORDS[:3]}
    with pytest.raises(Exception, match="damaged JSON record"):
        read_json_array(spark, _write(tmp_root, raw[:-1]), SCHEMA, split_bytes=16).collect()


@pytest.mark.parametrize("text, damaged", [
    ('[{"a": 1}, 7, {"a": 2}]', ['7, {"a": 2}']), ('[{"a": 1} {"a": 2}]', ['{"a": 2}']), ('[{"a": 1}, {"a": x}, {"a": 3}]', ['{"a": x}']),
    ('{"a": 1}, {"a": 2}', [', {"a": 2}']), ('[{"a": 1}]]', ["]]"])])
def test_text_between_records(spark, tmp_root, text, damaged):
    for size in (1, None):
        rows = read_json_array(spark, _write(tmp_root, text), SCHEMA, keep_corrupt=True, split_bytes=size).collect()
        assert [r[CORRUPT_COLUMN].strip(", ") for r in rows if r[CORRUPT_COLUMN] is not None] == [d.strip(", ") for d in damaged]
        assert all(r.a is None for r in rows if r[CORRUPT_COLUMN] is not None)


def test_bronze_from_a_split_document(spark, tmp_root, cards_file):
    from strata.plans import loads
    from tests.conftest import AS_OF
    rows = {split: sorted(map(str, loads.load_bronze(spark, f"{tmp_root}/lake-{split}", cards_file, AS_OF, split=split).collect()))
            for split in (False, True)}
    assert rows[True] == rows[False] and len(rows[True]) == 4
