from __future__ import annotations

import io
import zipfile

import pandas as pd
import pytest

from acreage.operators.cleaning import clean_transactions
from acreage.sources.landzip import HEADERS, PARKING_HEADERS, members, read_land_zip
from acreage.sources.reference import LOOKUP, build_lookup, file_sha256, read_reference
from acreage.sources.releases import Registry, ReleaseError
from acreage.sources.stata import read_stata
from fixtures import aliases, lookup

ROW = {
    "town": "南竿鄉", "type": "房地(土地+建物)", "trans_landsize": "50", "usage_type": "住宅區", "nonurban_type": "", "date": "1120115",
    "building_type": "公寓(5樓含以下無電梯)", "usage": "住家用", "date_complete": "1000101", "trans_size": "100", "room": "3", "hall": "2",
    "bath": "1", "manage": "有", "housing_totprice": "10000000", "h_price_m2": "100000", "parking_size": "0",
    "parking_price": "0", "note": "", "no": "A1"
}


def archive(path, files, parking=PARKING_HEADERS[0], drop=()):
    with zipfile.ZipFile(path, "w") as z:
        for name, rows in files.items():
            out = io.StringIO()
            keys = [k for k in ROW if k not in drop]
            out.write(
                "﻿" + ",".join(
                    parking if k == "parking_size" else HEADERS[k] for k in keys
                ) + "\n" + ",".join("english" for _ in keys) + "\n"
            )
            for r in rows:
                out.write(",".join(str((ROW | r)[k]) for k in keys) + "\n")
            z.writestr(name, out.getvalue())
    return str(path)


def test_zip_to_clean(spark, tmp_path):
    path = archive(
        tmp_path / "a.zip",
        {
            "z_lvr_land_a.csv": [{"no": "Z1"}, {"no": "Z2", "date": "112011", "usage_type": "商業區農"}],
            "I_LVR_LAND_A.csv": [{"no": "I1", "town": "西區"}], "z_lvr_land_b.csv": [{}]
        },
        PARKING_HEADERS[1]
    )
    raw = read_land_zip(spark, path)
    got = {r.no: r for r in raw.collect()}
    assert [got[k]._row_pos for k in ("I1", "Z1", "Z2")] == [1, 2, 3] and got["I1"].town == "東區" and got["I1"].county == "嘉義市"
    assert got["Z2"].usage_type == "農" and got["Z2"].trans_y == 11 and got["Z1"].trans_y == 112
    out = clean_transactions(raw, lookup(spark), aliases(spark), "r", end=11412)
    assert {r.source_transaction_id for r in out.clean.collect()} == {"I1", "Z1"}


def test_bad_archives(tmp_path, spark):
    (tmp_path / "x.zip").write_text("no zip")
    for path, what in (
        (str(tmp_path / "x.zip"), "not a ZIP"), (
            archive(tmp_path / "b.zip", {"other.csv": []}), "no transaction"
        ), (archive(tmp_path / "c.zip", {"y_lvr_land_a.csv": []}), "unknown"),
        (archive(tmp_path / "d.zip", {"z_lvr_land_a.csv": [], "Z_lvr_land_a.csv": []}), "two files"),
    ):
        with pytest.raises(ValueError, match=what):
            members(path)
    with pytest.raises(Exception, match="lacks"):
        read_land_zip(spark, archive(tmp_path / "e.zip", {"z_lvr_land_a.csv": [{}]}, drop=("note",))).collect()


def test_stata(spark, tmp_path):
    path = str(tmp_path / "t.dta")
    pd.DataFrame(
        {"no": [f"N{k}" for k in range(25)], "v": [float(k) if k % 5 else None for k in range(25)], "unused": range(25)}
    ).to_stata(path, write_index=False)
    got = sorted(map(tuple, read_stata(spark, path, ["no", "v"], rows=10).collect()))
    assert len(got) == 25 and got[0] == (1, "N0", None) and got[24] == (25, "N24", 24.0)
    with pytest.raises(Exception, match="missing"):
        read_stata(spark, path, ["nope"])


def test_reference(spark, tmp_path):
    (tmp_path / "l.csv").write_text(
        "legacy_county_code,legacy_town_code,county_id,town_id,city,district\nZ,01,09007,09007010,連江縣,南竿鄉\n", encoding="utf-8"
    )
    assert read_reference(spark, str(tmp_path / "l.csv"), LOOKUP, 1).first().town_id == "09007010"
    with pytest.raises(ValueError):
        read_reference(spark, str(tmp_path / "l.csv"), LOOKUP, 2)
    towns = spark.createDataFrame(
        [("Z", "01", "連江縣", "南竿鄉"), ("Z", "02", "連江縣", "北竿鄉")], "hsn_cd string, town_cd string, hsn_nm string, town_nm string"
    )
    ids = spark.createDataFrame(
        [("連江縣", "南竿鄉", "09007", "09007010"), ("連江縣", "北竿鄉", "09007", "09007020")],
        "hsn_nm string, town_nm string, county_id string, town_id string"
    )
    assert [r.district for r in build_lookup(towns, ids).collect()] == ["南竿鄉", "北竿鄉"]
    with pytest.raises(ValueError, match="without"):
        build_lookup(towns, ids.limit(1))


def test_releases(tmp_path):
    a, b = archive(tmp_path / "a.zip", {"z_lvr_land_a.csv": [{}]}), archive(
        tmp_path / "b.zip", {"z_lvr_land_a.csv": [{"no": "B"}]}
    )
    registry = Registry(tmp_path / "r")
    first = registry.register(a, released="2026-09-21", period_end=11509)
    assert first["created"] and not registry.register(a, released="2026-09-21", period_end=11509)["created"]
    assert registry.register(b, released="2026-09-21", period_end=11509)["release_id"] == "2026-09-21-r2"
    with pytest.raises(ReleaseError):
        registry.register(a, released="2026-09-21", period_end=11508)
    with pytest.raises(ReleaseError):
        registry.register(a, released="2026-9-21", period_end=11509)
    with pytest.raises(ReleaseError):
        registry.published("2026-09-21", "test", ok=True)
    registry.cleaned("2026-09-21", status="success")
    registry.published("2026-09-21", "test", ok=True)
    with pytest.raises(ReleaseError):
        registry.published("2026-09-21", "elsewhere")
    (tmp_path / "r" / first["archive_path"]).write_text("changed")
    with pytest.raises(ReleaseError, match="gone or changed"):
        registry.register(a, released="2026-09-21", period_end=11509)
    assert file_sha256(b) == registry.load()[1]["source_sha256"]
