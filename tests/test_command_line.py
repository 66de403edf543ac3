from tessera.__main__ import main

from test_mining import NAME, write_corpus


def test_build_and_dashboard(spark, tmp_path):
    write_corpus(tmp_path / "in")
    out = tmp_path / "out"
    main(["build", "--corpus", str(tmp_path / "in"), "--output-dir", str(out), "--as-of", "2010-12-31"])
    stock = spark.read.parquet(f"{out}/stock_by_date.parquet")
    assert stock.where("dimension = 'vintage_year'").count() == 10 and stock.columns == ["date", "dimension", "group_value", "count", "rank"]
    (out / "dashboard.template.html").write_text("__TRAS_JSON__ __EVENTS_JSON__ __STOCK_JSON__")
    main(["dashboard", "--dir", str(out)])
    assert "TRA-2010-02-03" in (out / "dashboard.html").read_text()


def test_classify_and_candidates(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files/a.htm").write_text(f"<p align=center>{NAME}</p>")
    (tmp_path / "files/b.txt").write_text("nothing")
    main(["classify", str(tmp_path / "files"), "-o", str(tmp_path / "keep"), "--drop-csv", str(tmp_path / "drop")])
    assert spark.read.option("header", True).csv(str(tmp_path / "keep")).count() == 1
    (tmp_path / "v.json").write_text('{"_id": "1:x", "_source": {"ciks": ["1"], "file_type": "EX-10.1", "file_date": "2001-01-01"}}\n')
    main(["candidates", f"v={tmp_path}/v.json", "-o", str(tmp_path / "c"), "--start", "2001-01-01"])
    assert spark.read.parquet(str(tmp_path / "c")).first()["phrase_variants_matched"] == "v"
