"""Stored enrichment, the document index, bronze repair and report files."""

from datetime import date, datetime

from stockyard.operators import reports
from stockyard.plans import refresh
from stockyard.sources import binding, sinks, tables

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_geo_upsert_restamps(spark, root, tmp_path):
    path = str(tmp_path / "geo")
    entities = spark.createDataFrame([("warehouse", "1", "01310-100"), ("warehouse", "2", "123")], "entity_type string, entity_id string, cep string")
    book = spark.createDataFrame(
        [("01310100", "", "Centro", "São Paulo", "sp", "3550308")],
        "cep string, logradouro string, bairro string, localidade string, uf string, ibge string",
    )
    for at in (T1, T2):
        refresh.refresh_geo(entities, book, path, at)
    row, = tables.read(spark, path).collect()
    assert (row.estado, row.regiao, row.logradouro, row._enriched_at) == ("São Paulo", "Sudeste", None, T2)
    assert float(row.latitude) == -23.5505


def test_weather_upsert(spark, tmp_path):
    path = str(tmp_path / "weather")

    def response(*days):
        text = '{"daily":{"time":[%s],"temperature_2m_mean":[%s],"weather_code":[%s]}}' % (
            ",".join(f'"2024-01-0{d}"' for d in days), ",".join(f"{d}.5" for d in days), ",".join("0" for _ in days),
        )
        return spark.createDataFrame([("SP", text)], "location_uf string, response string")

    refresh.refresh_weather(response(1, 2), path, T1)
    refresh.refresh_weather(response(2, 3), path, T2)
    got = {r.weather_date: r._enriched_at for r in tables.read(spark, path).collect()}
    assert got == {date(2024, 1, 1): T1, date(2024, 1, 2): T2, date(2024, 1, 3): T2}


def test_reindex_forgets_deleted_documents(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [("docs/a.md", "a" * 60), ("docs/b.md", "b" * 60)]
    for part in (rows, rows[:1]):
        refresh.reindex_documents(spark.createDataFrame(part, "p string, t string"), path, "p", "t")
    stored = tables.read(spark, path).collect()
    assert [r.source for r in stored] == ["docs/a.md"] and stored[0].point_id is not None


def test_repair_keeps_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = [("1", "old", T1), ("1", "new", T2), ("2", "only", T1)]
    tables.append(spark.createDataFrame(rows, "k string, v string, _cdc_loaded_at timestamp_ntz"), path)
    refresh.repair_bronze(spark, path, ["k"])
    assert sorted(r.v for r in tables.read(spark, path).collect()) == ["new", "only"]


def test_revenue_file(spark, tmp_path):
    path = tmp_path / "csv"
    df = spark.createDataFrame([(datetime(2024, 1, 1, 9), 2.5), (None, 1.0)], "issued_at timestamp_ntz, total_value double")
    sinks.write_csv(sinks.revenue_file(reports.revenue_by_day(df)), str(path), one_file=True)
    lines = next(path.glob("*.csv")).read_text().splitlines()
    assert lines == ["data,documentos,faturamento", "2024-01-01 00:00:00,1,2.5", "None,1,1.0"]


def test_estimate_files(spark, root, tmp_path):
    items = binding.order_items(spark, root)
    sinks.write_csv(sinks.product_file(reports.estimated_by_product(items, limit=None)), str(tmp_path / "p"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "p"))
    assert back.columns == ["cdproduto", "dsproduto", "qtd_total", "faturamento_total"]
    assert back.count() == items.select("cdproduto").distinct().count()
