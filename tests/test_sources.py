from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import fixtures as fx
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from kinomart.__main__ import main
from kinomart.plans.pipeline import register_views
from kinomart.session import materialize, shuffle_settings, work_folder
from kinomart.sources import tables
from kinomart.sources.schemas import PRIMARY_KEYS, SCHEMAS
from kinomart.sources.text import read_dump, unescape


def dump(tmp_path, *lines):
    path = tmp_path / "table.dat"
    path.write_text("".join(line + "\n" for line in [*lines, r"\.", "", ""]), encoding="utf-8")
    return str(path)


def test_dump_types(spark, tmp_path):
    path = dump(
        tmp_path,
        "1\tÄgir\\\\x\tan \\t b\t2006\t1\t6\t0.99\t\\N\t20.99\tPG-13\t2013-05-26 14:50:58.951"
        '\t{Trailers,"Deleted Scenes","a \\\\"b\\\\", c",NULL}\t\'ab\':1',
        "2\t\t\\N\t\\N\t1\t6\t0.99\t86\t20.99\tG\t2013-05-26 00:00:00\t\\N\t",
    )
    one, two = read_dump(spark, "film", path).orderBy("film_id").collect()
    assert (one.title, one.description, one.length) == ("Ägir\\x", "an \t b", None)
    assert one.last_update == datetime(2013, 5, 26, 14, 50, 58, 951000)
    assert one.special_features == ["Trailers", "Deleted Scenes", 'a "b", c', None]
    assert one.rental_rate == Decimal("0.99")
    # An empty field is an empty text, not a NULL.
    assert (two.title, two.description, two.release_year, two.fulltext) == ("", None, None, "")
    assert two.special_features is None
    assert read_dump(spark, "film", path).schema == SCHEMAS["film"]


def test_dump_booleans_and_bytes(spark, tmp_path):
    path = dump(
        tmp_path,
        "1\tA\tB\t3\t\\N\t1\tt\tab\t\\N\t2006-05-16 16:13:11.79328\t\\\\x89504e47",
        "2\tA\tB\t3\t\\N\t1\tf\tab\t\\N\t2006-05-16 16:13:11.79328\t\\N",
    )
    one, two = read_dump(spark, "staff", path).orderBy("staff_id").collect()
    assert (one.active, two.active) == (True, False)
    assert bytes(one.picture) == b"\x89PNG" and two.picture is None


def test_dump_padding(spark, tmp_path):
    path = dump(tmp_path, "1\tEnglish             \t2006-02-15 10:02:19")
    assert read_dump(spark, "language", path).first().name == "English"


def test_dump_with_a_wrong_field_count(spark, tmp_path):
    path = dump(tmp_path, "1\tEnglish")
    with pytest.raises(PySparkException, match="expected 3 fields"):
        read_dump(spark, "language", path).collect()


def test_dump_with_a_bad_value(spark, tmp_path):
    path = dump(tmp_path, "one\tEnglish\t2006-02-15 10:02:19")
    with pytest.raises(PySparkException):
        read_dump(spark, "language", path).collect()


@pytest.mark.parametrize(
    ("raw", "plain"),
    [(r"a\tb", "a\tb"), (r"a\\tb", r"a\tb"), (r"a\\\tb", "a\\\tb"), (r"\n\r\b\f\v", "\n\r\b\f\v"),
     (r"\q", "q"), (r"\\", "\\"), ("plain", "plain"), (None, None)],
)
def test_unescape(spark, raw, plain):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(unescape(F.col("v")).alias("v")).first().v == plain


def test_defaults(spark):
    film = fx.table(spark, "film", [fx.film(1, rate=None, rating=None, last_update=None), fx.film(2)])
    rows = tables.with_defaults(film.drop("rental_duration"), "film", "2020-01-01 00:00:00").collect()
    one, two = sorted(rows, key=lambda r: r.film_id)
    assert (one.rental_rate, one.rating, one.rental_duration) == (Decimal("4.99"), "G", 3)
    assert one.last_update == datetime(2020, 1, 1) and two.last_update == fx.LOADED
    customer = fx.table(spark, "customer", [{"customer_id": 1}])
    row = tables.with_defaults(customer, "customer", "2020-01-01 09:00:00").first()
    assert (row.activebool, row.create_date) == (True, date(2020, 1, 1))
    payment = fx.table(spark, "payment", [{"payment_id": 1}])
    assert tables.with_defaults(payment, "payment", "2020-01-01 00:00:00").columns == payment.columns


def test_table_selection():
    found = ["film", "film_list", "extra", "other_view"]
    assert tables.select_tables(found) == {"film": ("film_id",)}
    keyed = tables.select_tables(found, source_keys={"extra": ("id",), "film": ("other",)})
    assert keyed == {"film": ("film_id",), "extra": ("id",)}
    assert list(tables.select_tables(PRIMARY_KEYS)) == list(PRIMARY_KEYS)


def test_full_refresh_overwrites(spark):
    rows = fx.base()
    assert tables.replicate(lambda n: fx.table(spark, n, rows[n]), ["city", "film_list"]) == ["city"]
    assert spark.table("city").count() == 1
    rows["city"] = [c | {"city_id": i} for c in rows["city"] for i in (5, 6)]
    tables.replicate(lambda n: fx.table(spark, n, rows[n]), ["city"])
    assert {r.city_id for r in spark.table("city").collect()} == {5, 6}
    assert tables.discover(spark)["city"].fieldNames() == SCHEMAS["city"].fieldNames()


class FakeReader:
    def __init__(self, lo, hi):
        self.bounds, self.calls = Row(lo=lo, hi=hi), []

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return SimpleNamespace(first=lambda: self.bounds)


def test_jdbc_read_is_split_by_key():
    reader = FakeReader(1, 16049)
    tables.read_jdbc(SimpleNamespace(read=reader), "jdbc:x", "film_actor", {"user": "u"}, 4)
    (bounds, _), (table, options) = reader.calls
    assert "min(actor_id) lo" in bounds and table == "film_actor"
    assert options == {
        "column": "actor_id", "lowerBound": 1, "upperBound": 16050, "numPartitions": 4,
        "properties": {"user": "u"},
    }


def test_jdbc_read_of_an_empty_table():
    reader = FakeReader(None, None)
    tables.read_jdbc(SimpleNamespace(read=reader), "jdbc:x", "rental", {})
    assert reader.calls[1] == ("rental", {"properties": {}})


def test_command_line(spark, tmp_path, capsys):
    folder, out = str(tmp_path / "base"), str(tmp_path / "out")
    rows = fx.base()
    for name in SCHEMAS:
        materialize(fx.table(spark, name, rows[name]), f"{folder}/{name}")
    assert main(["build", "--source", "parquet", "--folder", folder, "--out", out]) == 1
    built = capsys.readouterr().out
    assert "FAIL dim_film unique_film_id: 1" in built and "FAIL customer foreign_key_address_id: 1" in built
    assert main(["check", "--out", out]) == 1
    assert capsys.readouterr().out == built


def test_wide_and_narrow_keys_load_alike(spark, tmp_path):
    rows = "SELECT CAST(id AS {kind}) AS {key}, timestamp_ntz '2020-01-01 00:00:00' AS last_update FROM VALUES (1), ({n}) AS t(id)"
    for kind, n in (("int", 70000), ("bigint", 5_000_000_000), ("smallint", 30000)):
        spark.sql(rows.format(kind=kind, key="film_id", n=n)).write.parquet(f"{tmp_path}/{kind}/inventory")
        found = tables.read_parquet(spark, "inventory", f"{tmp_path}/{kind}")
        assert sorted(r.film_id for r in found.collect()) == [1, n]
        assert dict(found.dtypes)["film_id"] == "bigint" and found.first().store_id is None
    with open(tmp_path / "odd.dat", "w") as file:
        file.write("5\t70000\t1\t2020-01-01 00:00:00\n")
    load = tables.loader(spark, "dump", str(tmp_path), {"inventory": "odd.dat"})
    assert load("inventory").first().film_id == 70000


def test_years_that_do_not_fit_raise(spark, tmp_path):
    spark.sql("SELECT 5000000000 AS release_year").write.parquet(f"{tmp_path}/film")
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        tables.read_parquet(spark, "film", str(tmp_path)).collect()


def test_a_table_is_replaced_only_by_a_complete_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = materialize(spark.range(5), path)
    again = materialize(first.selectExpr("id + 1 AS id"), path)  # reads what it replaces
    assert sorted(r.id for r in again.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="broken"):
        materialize(again.selectExpr("id + raise_error('broken') AS id"), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if ".old" in p.name] == []


def test_a_build_does_not_write_over_its_source(spark, tmp_path):
    rows = fx.base()
    for name in SCHEMAS:
        materialize(fx.table(spark, name, rows[name]), f"{tmp_path}/{name}")
    with pytest.raises(ValueError, match="holds the source"):
        main(["build", "--source", "parquet", "--folder", str(tmp_path), "--out", str(tmp_path)])


def test_work_folders_can_be_removed(spark, monkeypatch):
    from kinomart import session

    monkeypatch.setattr(session, "_work_folders", [])
    folder = work_folder(spark)
    materialize(spark.range(3), f"{folder}/t")
    session.remove_work_folders(spark)
    assert not session.folder_exists(spark, folder)


def test_a_source_defined_key_is_copied(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyed")
    frames = {"note": spark.range(2), "view": spark.range(3)}
    assert tables.replicate(frames.__getitem__, frames, "keyed", {"note": ("id",)}) == ["keyed.note"]
    assert list(tables.discover(spark, "keyed")) == ["note"]
    spark.sql("DROP DATABASE keyed CASCADE")


def test_defaults_as_of_now(spark):
    found = tables.with_defaults(spark.sql("SELECT 1 AS film_id"), "film").first()
    assert found.rating == "G" and found.last_update is not None


def test_shuffle_settings():
    assert shuffle_settings(10 << 30, 8)["spark.sql.shuffle.partitions"] == "40"
    assert shuffle_settings(1, 8)["spark.sql.shuffle.partitions"] == "8"


def test_ingest_names(spark):
    assert "zip_code" in tables.ingest_names(fx.models(spark)["customer_list"]).columns


def test_stored_copy(spark):
    folder = work_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    df = fx.models(spark)["staff_list"]
    stored = materialize(df, f"{folder}/staff_list")
    assert stored.schema == df.schema and stored.collect() == df.collect()
    assert tables.read_parquet(spark, "city", _stored_city(spark, folder)).first().city == "Lima"


def _stored_city(spark, folder):
    materialize(fx.models(spark)["city"], f"{folder}/city")
    return folder


def test_views(spark):
    register_views(fx.models(spark), ["stg_film", "film_list"])
    assert spark.sql("select count(*) n from stg_film").first().n == 3
    assert spark.sql("select max(fid) n from film_list").first().n == 2
