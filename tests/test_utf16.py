"""UTF-16 landing files read in byte ranges."""

import io
import os
import random
import tempfile

import pytest

from conftest import rows
from ledgerstar.sources import landing as SL
from ledgerstar.sources import utf16

COLS = ["a", "b", "c"]


def test_ranges_hold_every_line_once():
    """Random texts (with units that hold a newline's bytes), cut at every place, in both byte orders, with and without a mark."""
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(["a", "\n", "ਊ", "਀", "Ā", "\t", "\U0001f600", "é"]) for _ in range(rng.randrange(30)))
        want = text.split("\n")[:-1] if text.endswith("\n") or not text else text.split("\n")
        for order, codec, bom in (("little", "utf-16-le", b"\xff\xfe"), ("big", "utf-16-be", b"\xfe\xff")):
            for mark, told in ((b"", order), (bom, None), (bom, order)):
                raw, step, piece = mark + text.encode(codec), rng.choice([2, 4, 6, 64]), rng.choice([2, 4, 8, 1024])
                got = [x for lo in range(0, len(raw), step) for x in utf16.lines_in(io.BytesIO(raw), lo, lo + step, len(raw), told, piece)]
                assert got == want


def test_half_a_unit_is_an_error():
    with pytest.raises(ValueError, match="even"):
        list(utf16.lines_in(io.BytesIO(b"a\0b"), 0, 4, 3, "little"))


def _landed(text, encoding="utf-16"):
    p = os.path.join(tempfile.mkdtemp(prefix="landing-", dir="/tmp"), "rows.tsv")
    with open(p, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return p


def test_one_file_gives_several_tasks(spark):
    data = [(str(i), "" if i % 3 else "NULL", f"é{i}ਊĀ \"q\"") for i in range(5_000)]
    p = _landed("".join("\t".join(r) + "\n" for r in data))
    want = sorted((a, None, c) for a, _, c in data)
    assert rows(SL.read_landing(spark, p, COLS, encoding="UTF-16")) == want
    lines = utf16.read_lines(spark, p, "UTF-16", range_bytes=20_001)
    assert lines.rdd.getNumPartitions() == -(-os.path.getsize(p) // 20_000) > 5   # one task a range
    assert sorted(r["line"] for r in lines.collect()) == sorted("\t".join(r) for r in data)


def test_bad_rows_are_returned_and_fail_the_load(spark):
    p = _landed("1\tx\ty\n2\tshort\n\n3\tx\ty\tlong\n4\t\tno end")
    bad = SL.validate_landing(spark, p, COLS, encoding="UTF-16")
    assert rows(bad, "a", SL.CORRUPT) == [("2", "2\tshort"), ("3", "3\tx\ty\tlong")]
    with pytest.raises(Exception, match="malformed landing row"):
        SL.load_landing(spark, p, COLS, p + ".out", encoding="UTF-16")
    assert not os.path.exists(os.path.join(p + ".out", "_SUCCESS"))
    good = _landed("1\t\ty\n4\t\tno end", "utf-16-le")
    assert rows(SL.read_landing(spark, good, COLS, encoding="UTF-16LE")) == [("1", None, "y"), ("4", None, "no end")]


def test_empty_and_compressed_files(spark):
    assert rows(SL.read_landing(spark, _landed("", "utf-16-le"), COLS, encoding="UTF-16LE")) == []
    p = _landed("1\tx\ty\n")
    os.rename(p, p + ".gz")
    with pytest.raises(Exception, match="cannot be cut"):
        SL.read_landing(spark, p + ".gz", COLS, encoding="UTF-16").collect()
