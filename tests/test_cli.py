from __future__ import annotations

import json

import pytest

from acreage.cli import main
from fixtures import ALIASES, LOOKUP
from test_sources import archive


def test_clean_register_report(spark, tmp_path, capsys):
    (tmp_path / "l.csv").write_text(
        "legacy_county_code,legacy_town_code,county_id,town_id,city,district\n" + "\n".join(",".join(r) for r in LOOKUP) + "\n",
        encoding="utf-8"
    )
    (tmp_path / "a.csv").write_text(
        "legacy_county_code,raw_town,normalized_town\n" + "\n".join(",".join(r) for r in ALIASES) + "\n", encoding="utf-8"
    )
    path = archive(tmp_path / "x.zip", {"z_lvr_land_a.csv": [{"no": "Z1"}, {"no": "Z2", "town": "?"}]})
    args = [
        "clean", "--raw", path, "--lookup", str(tmp_path / "l.csv"), "--aliases", str(tmp_path / "a.csv"), "--output-dir",
        str(tmp_path / "out"), "--places", "4", "--place-aliases", "1"
    ]
    with pytest.raises(SystemExit):
        main(args)
    assert main([*args, "--period-end", "11412"]) == 0
    audit = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert audit["results"]["row_counts"] == {"input_rows": 2, "clean_rows": 1, "excluded_rows": 1, "reconciled": True}
    held = next((tmp_path / "out").glob("audit-*.json"))
    assert main(["report", str(held)]) == 0 and "unmapped_location | 1 | 50.00%" in capsys.readouterr().out
    assert main(
        [
            "register", "--source", path, "--release-date", "2026-09-21", "--period-end", "11509", "--release-root",
            str(tmp_path / "r")
        ]
    ) == 0
    both = [
        "release", "--source", path, "--release-date", "2026-09-21", "--period-end", "11509", "--release-root",
        str(tmp_path / "r"), *args[3:]
    ]
    capsys.readouterr()
    assert main(both) == 0
    done = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert done["cleaning"]["status"] == "success" and done["cleaning"]["row_counts"]["clean_rows"] == 1
    assert main(
        ["published", "--release-root", str(tmp_path / "r"), "--release-id", "2026-09-21", "--target", "test", "--batch", "b1"]
    ) == 0
    with pytest.raises(ValueError, match="4 rows, 368 expected"):
        main([*args[:-4], "--period-end", "11412"])
    capsys.readouterr()
    assert main(["profile", *args[1:7], "--output-dir", str(tmp_path / "csv")]) == 0
    names = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(names) == 34 and (tmp_path / "csv" / "parking_groups.csv").read_text("utf-8-sig").startswith("group,rows,share")
    assert (tmp_path / "csv" / "note_summary.csv").read_text("utf-8-sig").splitlines() == ["flag,rows", "blank,2", "nonblank,0"]
    twice = archive(tmp_path / "y.zip", {"z_lvr_land_a.csv": [{"no": "Z1"}, {"no": "Z1", "room": "9"}]})
    with pytest.raises(ValueError, match="conflicting"):
        main(["clean", "--raw", twice, *args[3:], "--period-end", "11412"])
