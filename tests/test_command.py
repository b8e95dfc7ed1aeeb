"""The command line."""

import glob
import shutil

import pytest
from conftest import SMALL

from tidemark.__main__ import main


def test_commands(spark, root, tmp_path, capsys):
    lake = ["--lake", "/root/testdata", "--schema", "sf0.001"]
    (catalog,) = main(["discover", *lake])
    assert catalog.count() == 63
    (log,) = main(
        ["migrate", root, *lake, "--stream", "orders", "--cursor", "orders=o_orderdate"]
        + ["--split-by", "orders=o_orderkey", "--tasks", "2"]
    )
    assert [(r.stream, r.n_rows, r.cursor) for r in log.collect()] == [
        ("orders", 1500, "o_orderdate")
    ]
    (found,) = main(["list", SMALL, "--prefix", "pa", "--extension", ".parquet"])
    assert [r.object_name for r in found.collect()] == ["pages.parquet", "part.parquet"]

    (part, *_) = glob.glob(f"{tmp_path}/lake/orders/sync_ms=*/part-*")
    box = tmp_path / "raw" / "box"
    box.mkdir(parents=True)
    shutil.copy(part, box / "2025_12_01_1764579501178_0.parquet")
    head, info, shape = main(
        ["--rows", "3", "show", f"file:{box}", "--order-by", "o_orderkey"]
    )
    assert (head.count(), info.count(), shape.first()[1:]) == (3, 6, (1500, 6))
    (log,) = main(["land-folders", f"file:{tmp_path}/raw", root])
    assert [(r.stream, r.n_rows) for r in log.collect()] == [("box", 1500)]
    assert "o_orderdate" in capsys.readouterr().out


def test_a_source_is_needed(monkeypatch):
    for name in ("HOST", "PORT", "SERVICE_NAME", "USER", "PASSWORD"):
        monkeypatch.delenv(f"ORACLE_{name}", raising=False)
    with pytest.raises(KeyError, match="ORACLE_HOST"):
        main(["discover", "--schema", "SALES"])
    with pytest.raises(SystemExit):
        main(["drop"])
