"""CSV with quoted line breaks: splits of any size against pandas."""

import random

import pandas as pd
import pyarrow as pa
import pytest

from clickroll.sources import quoted_csv as Q
from clickroll.sources.files import NULL_TOKENS

PIECES = ["a", "b", " ", '"', ",", "\n", "\r\n", "\r", "é", "x\ty", '""', "NA", "1.5", ""]


def _cell(rnd):
    v = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 6)))
    if rnd.random() < .55 or any(c in v for c in ",\r\n"):
        return '"' + v.replace('"', '""') + '"' + ('tail"x' if rnd.random() < .08 else "")
    return "z" + v if v.startswith('"') else v


def _text(rnd):
    width, end = rnd.randint(2, 4), rnd.choice(["\n", "\r\n"])
    head = [f"h{i}" for i in range(width)]
    if rnd.random() < .3:
        head[-1] = '"h\n"",last"'
    lines = [",".join(head)]
    for _ in range(rnd.randint(0, 40)):
        lines.append(",".join(_cell(rnd) for _ in range(width if rnd.random() < .9 else rnd.randint(1, width))))
        if rnd.random() < .1:
            lines.append(rnd.choice(["", " ", "\t "]))
    return ("﻿" if rnd.random() < .2 else "") + end.join(lines) + (end if rnd.random() < .7 else "")


def _pandas(path):
    frame = pd.read_csv(path, dtype=str)
    return list(frame.columns), [tuple(None if isinstance(x, float) else x for x in r) for r in frame.itertuples(index=False)]


def _null(x):
    return None if x in NULL_TOKENS else x


def _split_run(text, size):
    """What the two passes give for splits of ``size`` characters, without Spark."""
    blocks, at = {}, 0
    for line in text.split("\n")[:-1] if text.endswith("\n") else text.split("\n"):
        blocks.setdefault(at // size * size, []).append(line)
        at += len(line) + 1

    def batches(block, lines):
        for i in range(0, len(lines), 3):     # a split comes in several batches
            part = lines[i:i + 3]
            yield pa.RecordBatch.from_arrays([pa.array(["f"] * len(part)), pa.array([block] * len(part), pa.int64()), pa.array(part, pa.string())],
                                             names=["file", "block", "value"])
    summaries = [r for b, ls in blocks.items() for s in Q._summarised(batches(b, ls)) for r in s.to_pylist()]
    states, inside, first = {}, False, 0
    for s in summaries:
        states["f", s["block"]] = (inside, first)
        first += s["n_in"] if inside else s["n_out"]
        inside = s["end_in"] if inside else s["end_out"]
    assert not inside
    held = type("Held", (), {"value": states})
    found, pieces = {}, {}
    for b, ls in blocks.items():
        for out in Q._parsed(batches(b, ls), held, 9):
            for r in out.to_pylist():
                if r["piece"] is None:
                    assert r["n"] not in found
                    found[r["n"]] = [r[f"c{i}"] for i in range(9)]
                else:
                    pieces.setdefault(r["n"], []).append((r["block"], r["piece"]))
    for n, ps in pieces.items():
        assert n not in found
        got = Q._one_record(Q._LINE.findall("".join(p for _, p in sorted(ps))))
        found[n] = got + [None] * (9 - len(got))
    rows = [found[n] for n in range(len(found))]
    width = len([x for x in rows[0] if x is not None])
    return rows[0][:width], [tuple(_null(x) for x in r[:width]) for r in rows[1:]]


def test_any_split_gives_what_pandas_reads(tmp_path):
    rnd, compared = random.Random(11), 0
    for _ in range(120):
        text = _text(rnd)
        (tmp_path / "f.csv").write_text(text, newline="")
        try:
            want = _pandas(tmp_path / "f.csv")
        except pd.errors.ParserError:
            continue
        for size in (5, 23, 120, 10_000):
            assert _split_run(text, size) == want, repr(text)
        compared += 1
    assert compared > 90


def test_lone_carriage_returns_end_records(tmp_path):
    for text in ("a,b\r1,2\r3,4", 'a,b\r"x\ry",2\r\r3,4\r', "a,b\r1,2\n3,4\r\n5,6\r", "a,b\r\t \r1,2\r"):
        (tmp_path / "f.csv").write_text(text, newline="")
        assert _split_run(text, 5) == _pandas(tmp_path / "f.csv")


def test_state_of_a_line():
    for line, out, inn in [("a,b", False, True), ('a,"b', True, False), ('"a"",b', True, False), ('a"b', False, False), ('"a" "x,b', False, False),
                           ('","', False, True), ('""', False, True), ('x,"",y', False, True), ('",""', True, False)]:
        assert (Q.after(line, False), Q.after(line, True)) == (out, inn), line


@pytest.fixture
def tiny_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "70")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_spark_reader_with_tiny_splits(spark, tiny_splits, tmp_path):
    rnd = random.Random(4)
    rows = [[f"{i}", "".join(rnd.choice('ab",\n\r ') for _ in range(rnd.randint(0, 30))), rnd.choice(["", "NA", "x"])] for i in range(60)]
    body = "".join(",".join('"' + c.replace('"', '""') + '"' for c in r) + "\r\n" for r in rows)
    (tmp_path / "f.csv").write_text('id,"a long\nheader, that crosses a split: ' + "x" * 90 + '",c\r\n' + body, newline="")
    header, got = Q.read_csv_text(spark, str(tmp_path / "f.csv"))
    names, want = _pandas(tmp_path / "f.csv")
    assert header == names
    lines = sorted(tuple(r) for r in got.collect())
    assert [r[0] for r in lines] == list(range(60))
    assert [tuple(_null(x) for x in r[1:]) for r in lines] == want


def test_positions_are_dense_over_files(spark, tmp_path):
    for i, n in enumerate([3, 0, 4]):
        (tmp_path / f"part-{i}.csv").write_text("k,v\n" + "".join(f'{i}{j},"x\ny"\n' for j in range(n)))
    (tmp_path / "part-9.csv").write_text("")
    _, rows = Q.read_csv_text(spark, str(tmp_path))
    assert sorted((r.row_no, r.k) for r in rows.collect()) == list(enumerate(["00", "01", "02", "20", "21", "22", "23"]))


@pytest.mark.parametrize("text, says", [('a,b\n1,"open\n2,3\n', "ends inside quotes"), ("", "no header"), ("a,b\n1,2,3\n", "3 cells")])
def test_broken_files_fail(spark, tmp_path, text, says):
    (tmp_path / "f.csv").write_text(text)
    with pytest.raises(Exception, match=says):
        Q.read_csv_text(spark, str(tmp_path / "f.csv"))[1].collect()


def test_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="headers differ"):
        Q.read_csv_text(spark, str(tmp_path))
