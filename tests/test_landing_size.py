"""What a landing writes: no text is shuffled, and files are compressed."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from matchmart import registry
from matchmart.sources import tables as sources
from matchmart.sources.documents import document_text, land_raw, read_documents, read_raw_text
from matchmart.sources.tables import buckets, bucketed_documents, tables_to_documents


@pytest.fixture(scope="module")
def tables_dir(spark, tmp_path_factory):
    """Orders that come twice or have no key or lines, lines without an order or part."""
    d = str(tmp_path_factory.mktemp("tables"))
    day = F.expr("timestamp'1996-03-01' + make_interval(0, 0, 0, cast(id % 500 as int))")
    orders = spark.range(400).select(
        F.expr("CASE WHEN id % 40 <> 7 THEN id - id % 20 div 19 END").alias("o_orderkey"),
        F.expr("CASE WHEN id % 20 = 19 THEN id - 1 ELSE id END % 30").alias("o_custkey"),
        F.expr("element_at(array('F', 'O', 'P'), cast(id % 20 div 19 as int) + 1)").alias("o_orderstatus"),
        F.expr("id * 1.5D").alias("o_totalprice"),
        day.alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    orders.union(orders.limit(20)).write.parquet(f"{d}/orders.parquet")
    spark.range(1500).select(
        F.expr("CASE WHEN id % 90 <> 5 THEN (id * 7) % 450 END").alias("l_orderkey"),
        F.expr("id % 60").alias("l_partkey"),
        F.expr("id % 101").alias("l_suppkey"),
        F.expr("cast(id % 7 + 1 as int)").alias("l_linenumber"),
        F.expr("cast(id % 50 as double)").alias("l_quantity"),
        F.expr("id * 3.25D").alias("l_extendedprice"),
        F.expr("(id % 10) / 100D").alias("l_discount"),
        F.expr("(id % 8) / 100D").alias("l_tax"),
        F.expr("element_at(array('R', 'A', 'N'), cast(id % 3 as int) + 1)").alias("l_returnflag"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'F' END").alias("l_linestatus"),
    ).write.parquet(f"{d}/lineitem.parquet")
    parts = spark.range(50).selectExpr("id AS p_partkey", "concat('B', id) AS p_brand", "cast(id % 50 as int) AS p_size")
    parts.union(parts.limit(2)).write.parquet(f"{d}/part.parquet")
    return d


def texts(rows):
    return sorted((r["raw_json"], r["ingest_date"]) for r in rows.collect())


def test_documents_by_buckets_are_the_same_and_need_no_shuffle(spark, tables_dir):
    expected = texts(document_text(tables_to_documents(spark, tables_dir)))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed_documents(spark, tables_dir) as docs:
            assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()
            assert texts(document_text(docs)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(expected) == 400 and not [t for t in spark.catalog.listTables() if t.name.startswith("t_")]


def test_raw_files_are_made_without_a_shuffle(spark, tables_dir, tmp_path):
    docs = tables_to_documents(spark, tables_dir).coalesce(2).localCheckpoint()
    land_raw(docs, str(tmp_path / "raw"), docs_per_file=50, compression="bzip2")
    names = [f for _, _, fs in os.walk(tmp_path / "raw") for f in fs if f.startswith("part-")]
    assert 8 <= len(names) <= 12 and all(f.endswith(".bz2") for f in names)
    back = read_documents(spark, str(tmp_path / "raw")).select("metadata.matchId", "ingest_date")
    was = docs.select("metadata.matchId", "ingest_date")
    assert sorted(map(str, back.collect())) == sorted(map(str, was.collect()))


def test_landed_copies_are_compressed(spark, tables_dir):
    for layout in ("jsonl", "raw"):
        root = registry._landed(spark, tables_dir, layout)
        files = [os.path.join(d, f) for d, _, fs in os.walk(root.removeprefix("file:")) for f in fs if f.startswith("part-")]
        assert files and all(f.endswith(".bz2") for f in files)
    assert texts(read_raw_text(spark, registry.staging(spark, tables_dir))) == texts(
        document_text(tables_to_documents(spark, tables_dir))
    )


def test_a_layer_is_stored_when_it_is_asked_for(spark, tables_dir):
    assert registry.q_dim_patch(spark, tables_dir).count() > 0
    shared = os.path.dirname(registry.staging(spark, tables_dir)).removeprefix("file:")
    tag = registry._snapshot_tag(spark, tables_dir)
    stored = {n for n in registry.LAYER_TABLES if os.path.exists(f"{shared}/{n}-{tag}")}
    assert stored == {"dwd_match"}
    log = [tuple(r) for r in registry.q_stage_log(spark, tables_dir).collect()]
    assert [r[0] for r in log] == [*registry.LAYER_TABLES, "total"]
    assert log[0][1] == 400 and log[-1][1] == sum(r[1] for r in log[:-1])


def test_buckets_grow_with_the_table(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [buckets(spark, n) for n in (0, 1, 1 << 40)] == [1, 1, 1 << 17]
    assert buckets(spark, width << 20) == width


def test_a_manifest_reads_the_documents_once(spark, tables_dir):
    _, manifest = registry._manifest(spark, tables_dir)
    read = manifest.inputFiles()
    assert read and not any("/jsonl-" in f for f in read)


def test_a_rule_stores_the_layers_it_reads(spark, tmp_path):
    spark.range(30).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "1.5D AS o_totalprice",
        "timestamp'1996-03-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    # Four lines an order, but 20 in order 3, with numbers that come twice; 8 of them
    # have their number alone, 4 numbers are shared by three.
    spark.range(136).selectExpr(
        "CASE WHEN id < 120 THEN id div 4 ELSE 3 END AS l_orderkey", "id % 9 AS l_partkey", "id % 10 AS l_suppkey",
        "cast(CASE WHEN id < 120 THEN id % 4 + 1 ELSE (id - 120) % 12 + 1 END as int) AS l_linenumber",
        "1.0D AS l_quantity", "id * 3.25D AS l_extendedprice", "0.1D AS l_discount", "0.1D AS l_tax",
        "'A' AS l_returnflag", "'F' AS l_linestatus",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(9).selectExpr("id AS p_partkey", "concat('B', id) AS p_brand", "cast(id as int) AS p_size").write.parquet(
        str(tmp_path / "part.parquet")
    )
    d = str(tmp_path)
    shared = os.path.dirname(registry.staging(spark, d)).removeprefix("file:")
    tag = registry._snapshot_tag(spark, d)
    stored = lambda: {n for n in registry.LAYER_TABLES if os.path.exists(f"{shared}/{n}-{tag}")}
    found = [registry.QUERIES[n](spark, d).first()["actual_value"] for n in ("dq03", "dq04")]
    assert found == ["30", "4"] and stored() == {"dwd_player_match"}
    registry.QUERIES["dq07"](spark, d).collect()
    assert stored() == set(registry.LAYER_TABLES)
    assert {r["rule_id"]: r["actual_value"] for r in registry.q_dq_report(spark, d).collect()}["DQ03"] == "30"


def test_rows_of_an_order_are_stored_side_by_side(spark, tables_dir):
    with bucketed_documents(spark, tables_dir):
        stored = [t.name for t in spark.catalog.listTables() if t.name.endswith(("_orders", "_lines"))]
        assert len(stored) == 2
        for name in stored:
            kind = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
            assert kind["Bucket Columns"] == kind["Sort Columns"]


def test_lines_meet_large_parts_without_a_shuffle(spark, tables_dir):
    """Not a line is shuffled for its part, whatever the parts' size, and lines of one
    part are spread over tasks."""
    expected = texts(document_text(tables_to_documents(spark, tables_dir)))
    made, limit = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    write = sources._with_parts

    def seen(lines, parts, *also):
        made.append(write(lines, parts, *also))
        return made[-1]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    sources._with_parts = seen
    try:
        with bucketed_documents(spark, tables_dir) as docs:
            assert "Exchange" not in made[0]._jdf.queryExecution().executedPlan().toString()
            stored = [t.name for t in spark.catalog.listTables() if t.name.endswith("_lines_by_part")]
            assert spark.table(stored[0]).where("l_partkey = 7").select("l_salt").distinct().count() > 2
            assert texts(document_text(docs)) == expected
    finally:
        sources._with_parts = write
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_large_parts_are_copied_to_slices_of_the_orders(spark, tables_dir):
    """Lines are stored once; of them only part and slice are brought to large parts, and
    a slice gets a copy of each part that its lines name."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        with bucketed_documents(spark, tables_dir):
            stored = {t.name.split("_", 2)[2]: spark.table(t.name) for t in spark.catalog.listTables() if t.name.startswith("t_")}
            assert set(stored) == {"orders", "lines", "lines_by_part", "parts", "parts_by_slice"}
            assert set(stored["lines_by_part"].columns) == {"l_partkey", "l_salt", "l_slice"}
            lines, copies = stored["lines"], stored["parts_by_slice"]
            assert {"bigint"} == {dict(stored[t].dtypes)[c] for t, c in (("lines", "l_slice"), ("orders", "o_slice"))}
            parts = stored["parts"].where("p_salt = 0").select("p_partkey")
            named = lines.selectExpr("l_slice", "l_partkey AS p_partkey").distinct().join(parts, "p_partkey")
            assert sorted(map(tuple, copies.select("p_slice", "p_partkey").collect())) == sorted(
                map(tuple, named.select("l_slice", "p_partkey").collect())
            )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_slices_fill_the_buckets_evenly(spark):
    for n, each in ((1, 8), (3, 3), (100, 1)):
        numbers = sources.slices(spark, n, each)
        dealt = spark.createDataFrame([(i,) for i in numbers], "s bigint").selectExpr(f"pmod(hash(s), {n}) AS b")
        assert [r["count"] for r in dealt.groupBy("b").count().collect()] == [each] * n


def test_stored_keys_have_no_dictionaries(spark, tables_dir, tmp_path):
    """Keys in order take a byte or two: their differences, not a dictionary and its numbers."""
    rows = spark.range(0, 600_000, 3, 1).selectExpr("id div 12 AS k", "id * 7919 % 600000 AS part", "'x' AS s")
    rows.write.option("compression", "zstd").parquet(str(tmp_path / "plain"))
    rows.write.options(**sources.packed(rows)).parquet(str(tmp_path / "packed"))
    size = lambda d: sum(p.stat().st_size for p in (tmp_path / d).glob("part-*"))
    assert size("packed") < 0.9 * size("plain")
    assert spark.read.parquet(str(tmp_path / "packed")).exceptAll(rows).count() == 0
