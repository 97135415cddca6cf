from test_bronze import landing_file

from tripmart.__main__ import main


def test_cli_refresh_question_checks(spark, tmp_path, capsys):
    land = tmp_path / "landing"
    land.mkdir()
    for svc in ("yellow", "green"):
        landing_file(land, svc, "2024-01", n=4)
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n10,Queens,Astoria,Boro Zone\n"
                     "20,Manhattan,Midtown,Yellow Zone\n")
    root = str(tmp_path / "wh")
    main(["refresh", "--landing", str(land), "--zones-csv", str(zones), "--root", root,
          "--plan-start", "2023-12-01", "--plan-end", "2024-02-29"])
    out = capsys.readouterr().out
    assert '"yellow": {"rows": 4' in out
    main(["question", "q03_top_pickup_zones", "--root", root, "--year", "2024", "--n", "5"])
    out = capsys.readouterr().out
    assert "Astoria" in out and "8" in out
    main(["checks", "--root", root])
    assert "trip_key" in capsys.readouterr().out
