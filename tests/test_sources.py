"""CSV extracts: encodings, embedded newlines, missing tokens, harmonisation, union (A1-A4, B1-B2)."""
import random
import time

import pytest

from sevscope import schema as S
from sevscope.sources import extracts as X
from sevscope.sources import records as R


def _write(path, text, enc):
    with open(path, "w", encoding=enc, newline="") as f:
        f.write(text)


def test_read_extracts(spark, tmp_path):
    cur = tmp_path / "ads_current.csv"
    arc = tmp_path / "l2_prev.csv"
    _write(cur, 'Report ID,Report Version,Any Air Bags Deployed?,Narrative,SV Precrash Speed (MPH)\n'
                'R1,2,Yes,"line one\nline two",25\n'
                'R1,1,No,NA,bad\n', "utf-8")
    _write(arc, 'Report ID,Report Version,SV Any Air Bags Deployed?,Narrative,Weather - Fog/Smoke\n'
                'R7,,N/A,"Café crash, AV stopped",Y\n', "latin-1")
    df = X.read_extracts(spark, [X.Extract(str(cur), "UTF-8", "ADS", "current"),
                                 X.Extract(str(arc), "ISO-8859-1", "L2", "archived")])
    rows = {(r.report_id, r.report_version): r for r in df.collect()}
    assert set(df.columns) >= {"report_id", "airbag_text", "narrative", "weather_fog", "automation_level",
                               "era", "source_ord"}
    r = rows[("R1", 2.0)]
    assert r.narrative == "line one\nline two" and r.sv_speed_mph == 25.0 and r.automation_level == "ADS"
    bad = rows[("R1", 1.0)]
    assert bad.narrative is None and bad.sv_speed_mph is None      # NA token; try_cast
    a = rows[("R7", None)]
    assert a.narrative == "Café crash, AV stopped" and a.airbag_text is None and a.era == "archived"
    assert a.weather_fog == "Y" and a.source_ord == 1


def test_undeclared_columns_are_numbers_if_all_values_are(spark, tmp_path):
    path = tmp_path / "ads.csv"
    _write(path, "Report ID,Report Version,Model.Year,Mileage,Empty,Code\n"
                 "1,1,2020,1.5e3,,7\n2,1,NA, 12 ,,1d\n3,1,2021,-.5,,9\n", "utf-8")
    ex = [X.Extract(str(path), "UTF-8", "ADS", "current")]
    df = X.read_extracts(spark, ex)
    kinds = dict(df.dtypes)
    assert [kinds[c] for c in ("report_id", "report_version", "Model.Year", "Mileage", "Empty", "Code")] == \
        ["string", "double", "double", "double", "string", "string"]
    rows = sorted(df.select("report_id", "`Model.Year`", "Mileage").collect())
    assert [tuple(r) for r in rows] == [("1", 2020.0, 1500.0), ("2", None, 12.0), ("3", 2021.0, -0.5)]
    assert dict(X.read_extracts(spark, ex, infer=False).dtypes)["Mileage"] == "string"


@pytest.fixture
def small_splits(spark):
    """Splits of 600 bytes, so records cross several of them."""
    keys = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("seed, newline, encoding", [(1, "\n", "utf-8"), (2, "\r\n", "utf-8"), (3, "\n", "latin-1"), (4, "\n", "utf-8")])
def test_split_records_match_the_whole_file_reader(spark, small_splits, tmp_path, seed, newline, encoding):
    rng = random.Random(seed)
    pieces = ["a", "b", " ", ",", '"', "\n", "\n\n", "é", 'x"y', '","', "\r\n"]
    lines = ["k,first,second"] if newline != "\n" or seed == 1 else ['k,"fi""\nrst",second']
    for i in range(50):
        row = [str(i)]
        for _ in range(2):
            kind = rng.randrange(6)
            body = "".join(rng.choice(pieces) for _ in range(rng.randrange(900 if kind == 0 else 50)))
            bare = "".join(c for c in body if c not in ",\r\n").lstrip('"')
            row.append({1: bare, 2: "", 3: '""'}.get(kind, '"' + body.replace('"', '""') + '"'))
        lines.append(",".join(row))
        if rng.random() < 0.1:
            lines.append("")
    path = tmp_path / "extract.csv"
    _write(path, newline.join(lines) + (newline if seed % 2 else ""), encoding)
    name = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1"}[encoding]
    assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > 10
    whole = X.read_csv_text(spark, str(path), name, split=False)
    split = X.read_csv_text(spark, str(path), name)             # by its size
    assert split.columns == whole.columns and whole.count() == 50
    assert _rows(split) == _rows(whole)


def test_split_records_of_odd_files(spark, small_splits, tmp_path):
    """A header longer than a split, blank lines before it, a header alone, several files, a quote that never closes."""
    wide = "k," + ",".join(f"column_{i}" for i in range(40))
    files = {"a": "\n\n" + wide + "\n1," + "x" * 700 + '\n2,"y\n\n' + "z\n" * 200 + '"\n', "b": wide + "\n", "c": wide + '\n3,"open\n' + "w\n" * 300 + "end"}
    for name, text in files.items():
        _write(tmp_path / f"{name}.csv", text, "utf-8")
    got = X.read_csv_text(spark, str(tmp_path), split=True)
    rows = {r["k"]: r["column_0"] for r in got.collect()}
    assert got.columns == wide.split(",") and len(rows) == 3
    assert rows["1"] == "x" * 700 and rows["2"] == "y\n\n" + "z\n" * 200 and rows["3"].startswith("open\nw\n") and rows["3"].endswith("w\nend")


def test_start_of_splits_by_plain_composition(spark):
    """Windows over split functions against a plain walk."""
    rng = random.Random(7)
    rows = [(f"f{f}", b * 100, rng.randrange(2), rng.randrange(2), rng.random() < 0.6, rng.random() < 0.2, False)
            for f in range(5) for b in range(60)]
    want = {}
    for f in range(5):
        inside, owner, filled = 0, None, False
        for file, block, out, within, closes, blank, _ in (r for r in rows if r[0] == f"f{f}"):
            want[file, block] = (inside, owner, not filled and not blank)
            end = within if inside else out
            if end and (not inside or closes):
                owner = block
            inside, filled = end, filled or not blank
    got = R.split_starts(spark.createDataFrame(rows, R._ENDS)).collect()
    assert {(r.file, r.block): (r.inside, r.owner, r.header) for r in got} == want


def test_line_ends_in_linear_time():
    line = b'"' + b'""' * 500_000 + b"x," * 500_000
    start = time.monotonic()
    assert R._ends_inside(line, 0) == 1 and R._ends_inside(line + b'"', 0) == 0 and R._ends_inside(b'a"b"' * 500_000, 0) == 0
    assert time.monotonic() - start < 2


def test_harmonise_clash_merges(spark):
    df = spark.createDataFrame([(None, "old"), ("new", "old2")], "`VIN Decoded` string, `VIN - Unknown` string")
    out = X.harmonise(df, S.ARCHIVED_RENAME).collect()
    assert [r["VIN Decoded"] for r in out] == ["old", "new"]


def test_streaming_ingest(spark, tmp_path):
    from sevscope.streaming.ingest import ingest_extract_drops
    drop = tmp_path / "drop"
    drop.mkdir()
    _write(drop / "a.csv", "Report ID,Report Version,Narrative\nR1,1,first\nR2,NA,second\n", "utf-8")
    cols = ["Report ID", "Report Version", "Narrative"]
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    ingest_extract_drops(spark, str(drop), cols, "ADS", "current", out, ck)
    _write(drop / "b.csv", "Report ID,Report Version,Narrative\nR1,2,third\n", "utf-8")
    ingest_extract_drops(spark, str(drop), cols, "ADS", "current", out, ck)
    rows = sorted((r.report_id, r.report_version) for r in spark.read.parquet(out).collect())
    assert rows == [("R1", 1.0), ("R1", 2.0), ("R2", None)]


def test_lines_are_cut_by_the_batch():
    """No Python call a line: cutting 20,000 lines takes few calls, with the records and end states of the lines."""
    import sys

    import pyarrow as pa
    lines = [b'1,"a', b'', b'b ""x"", c"', b'2,z'] * 5_000
    n, calls = len(lines), []
    base = {"file": pa.array(["f"] * n), "block": pa.array([0] * n, pa.int64()), "line": pa.array(lines, pa.binary())}
    start = {"inside": pa.array([0] * n, pa.int32()), "owner": pa.nulls(n, pa.int64()), "header": pa.array([True] * n), "crlf": pa.array([False] * n)}
    batch = pa.RecordBatch.from_pydict({**base, **start})
    sys.setprofile(lambda frame, event, arg: calls.append(1) if event == "call" and frame.f_code.co_filename == R.__file__ else None)
    try:
        ends = [r for b in R._split_ends(iter([batch])) for r in b.to_pylist()]
        cut = [r["text"] for b in R._cut_records(iter([batch])) for r in b.to_pylist()]
    finally:
        sys.setprofile(None)
    assert [(r["ends_out"], r["closes_in"], r["blank"]) for r in ends] == [(0, True, False)]
    assert cut == ([b'1,"a\n\nb ""x"", c"', b'2,z'] * 5_000)[1:]
    assert len(calls) < 200


def test_extracts_are_read_side_by_side(spark, monkeypatch, tmp_path):
    import threading

    from sevscope.sources import extracts as X
    paths = []
    for i in range(2):
        paths.append(str(tmp_path / f"x{i}.csv"))
        (tmp_path / f"x{i}.csv").write_text(f"Report ID,other\nR{i},v{i}\n")
    both, read = threading.Barrier(2, timeout=30), X.read_csv_text

    def met(*args, **kwargs):
        both.wait()  # passes only when two reads have begun
        return read(*args, **kwargs)
    monkeypatch.setattr(X, "read_csv_text", met)
    out = X.read_extracts(spark, [X.Extract(p, "UTF-8", "ADS", "current") for p in paths])
    assert sorted((r["other"], r["source_ord"]) for r in out.collect()) == [("v0", 0), ("v1", 1)]
