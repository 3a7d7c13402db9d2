import gzip
import json

import pytest
from pyspark.sql import functions as F

from matchlake import sources
from matchlake.session import shared_folder


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=2), encoding="utf-8")


def test_arrays_of_records_take_partitions_from_folders(spark, tmp_path, rows):
    put(tmp_path / "league=x/season=2024/day.json", '[{"id": 1, "team": {"name": "a"}}, {"id": 2}]')
    put(tmp_path / "league=y/season=2023/day.json", '{"id": 3}\n{"id": 4}')
    schema = "id bigint, team struct<name:string>, league string, season int"
    df = sources.read_json_records(spark, str(tmp_path), schema).select("id", "team.name", "league", "season")
    assert rows(df) == [(1, "a", "x", 2024), (2, None, "x", 2024), (3, None, "y", 2023), (4, None, "y", 2023)]


def test_documents_are_found_at_any_depth(spark, tmp_path, rows):
    put(tmp_path / "league=x/2024/a.json", {"competition": {"code": "PL"}, "matches": [{"id": 1}, {"id": 2}]})
    put(tmp_path / "b.json", {"competition": {"code": "SA"}, "matches": []})
    put(tmp_path / "notes.txt", "not a document")
    df = sources.read_json_documents(spark, str(tmp_path), "competition struct<code:string>, matches array<struct<id:bigint>>")
    assert df.columns == ["competition", "matches"]
    assert rows(df.select("competition.code", F.size("matches"))) == [("PL", 2), ("SA", 0)]


def test_csv_columns_follow_the_header(spark, tmp_path, rows):
    with gzip.open(tmp_path / "players.csv.gz", "wt") as out:
        out.write("extra,name,player_id,value\nz,a,1,1.5\nz,,x,\n")
    df = sources.read_csv(spark, str(tmp_path), "player_id int, name string, value double", partitions=3)
    assert rows(df) == [(1, "a", 1.5), (None, None, None)]
    assert df.rdd.getNumPartitions() == 3


def test_an_empty_dataset_is_an_error(frame):
    with pytest.raises(FileNotFoundError):
        sources.require_rows(frame([], "a int"), "nothing")


def test_rows_typed_in_become_a_frame(spark):
    df = sources.rows_frame(spark, [{"home_team": "a", "away_team": "b"}], "home_team string, away_team string")
    assert tuple(df.first()) == ("a", "b")


def test_envelopes_are_split_by_errors_and_payload(frame, rows):
    df = frame(
        [(1, None, [(1,)]), (2, "[]", [(2,), (3,)]), (3, "{ }", []), (4, '["limit"]', [(4,)]), (5, '{"k": 1}', None),
         (6, "", None), (7, "null", [(5,)])],
        "id int, errors string, response array<struct<x:int>>",
    )
    accepted, rejected = sources.decode_envelopes(df)
    assert rows(accepted) == [(1, 1), (2, 2), (2, 3), (7, 5)]
    assert rows(rejected.select("id", "reason")) == [(3, "empty"), (4, "errors"), (5, "errors"), (6, "empty")]


def test_groups_come_from_the_first_element_only(frame, rows):
    schema = "id int, response array<struct<league:struct<standings:array<array<struct<rank:int>>>>>>"
    first, second = (([[(1,), (2,)], [(3,)], []],),), (([[(9,)]],),)
    df = frame([(1, [first, second]), (2, []), (3, None)], schema)
    assert rows(sources.flatten_groups(df)) == [(1, 1), (1, 2), (1, 3)]


def test_slices_carry_the_league_along_the_keys(frame, rows):
    clubs = frame([(1, "GB1"), (2, "ES1"), (3, "XX")], "club_id int, domestic_competition_id string")
    players = frame([(10, 1), (11, 2), (12, 3), (13, None)], "player_id int, current_club_id int")
    valuations = frame([(10, 1.0), (10, 2.0), (12, 3.0)], "player_id int, value double")
    sliced = sources.slice_by_league(clubs, players, valuations)
    assert rows(sliced["clubs"].select("club_id", "league")) == [(1, "premier_league"), (2, "la_liga")]
    assert rows(sliced["players"].select("player_id", "league")) == [(10, "premier_league"), (11, "la_liga")]
    assert rows(sliced["player_valuations"].select("player_id", "value", "league")) == [
        (10, 1.0, "premier_league"),
        (10, 2.0, "premier_league"),
    ]


@pytest.mark.parametrize(("overwrite", "left"), [("static", [(2, "y", 2024)]), ("dynamic", [(1, "x", 2023), (2, "y", 2024)])])
def test_overwrite_scope(spark, tmp_path, frame, rows, overwrite, left):
    path, schema = str(tmp_path / "out"), "id int, league string, season int"
    sources.write_files(frame([(1, "x", 2023)], schema), path, partition_by=("league", "season"))
    later = frame([(2, "y", 2024)], schema)
    sources.write_files(later, path, partition_by=("league", "season"), overwrite=overwrite)
    assert rows(sources.read_parquet(spark, path).select("id", "league", "season")) == left


def test_partitioned_write_leaves_few_files(spark, tmp_path):
    df = spark.range(0, 10_000, numPartitions=16).withColumn("league", (F.col("id") % 3).cast("string"))
    sources.write_files(df, str(tmp_path / "out"), partition_by=("league",))
    assert len(list((tmp_path / "out").rglob("*.parquet"))) <= 6


def test_file_count_and_nulls_of_a_json_export(spark, tmp_path, frame):
    df = frame([(i, None) for i in range(20)], "a int, b string").repartition(5)
    sources.write_files(df, str(tmp_path / "out"), "json", files=1, ignoreNullFields="false")
    (part,) = (tmp_path / "out").glob("part-*.json")
    assert part.read_text().splitlines()[0].endswith('"b":null}')


def test_records_land_below_their_day(spark, tmp_path, frame, rows):
    df = frame([(1, "x", 2024)], "id bigint, league string, season int")
    sources.land_records(df, str(tmp_path / "raw"), "2025-01-01")
    sources.land_records(df, str(tmp_path / "raw"), "2025-01-02")
    schema = "id bigint, league string, season int, ingest_date string"
    back = sources.read_json_records(spark, str(tmp_path / "raw"), schema)
    assert rows(back) == [(1, "x", 2024, "2025-01-01"), (1, "x", 2024, "2025-01-02")]


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = shared_folder(spark, "here")
    assert "/here-" in folder and (root is None or folder.startswith(root))
    assert folder != shared_folder(spark, "here")


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    put(tmp_path / "a.csv", "a,b\n1,x\n")
    put(tmp_path / "b.csv", "b,a\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, str(tmp_path), "a string, b string").collect()


def test_lines_that_are_no_records_are_told(spark, tmp_path, rows):
    put(tmp_path / "league=x/day.json", '{"id": 1}\n{"id": 2\n{"id": "no number"}\n')
    good, rejected = sources.split_json_records(spark, str(tmp_path), "id bigint")
    assert rows(good) == [(1, "x")]
    assert rows(rejected.select("value")) == [('{"id": "no number"}',), ('{"id": 2',)]


def test_arrays_over_several_lines(spark, tmp_path, rows):
    put(tmp_path / "a.json", [{"id": 1}, {"id": 2}])
    assert rows(sources.read_json_records(spark, str(tmp_path), "id bigint", multi_line=True)) == [(1,), (2,)]


def test_landing_a_day_again_replaces_it(spark, frame, tmp_path, rows):
    schema = "id int, league string, season int"
    for day, values in (("2025-01-01", [1, 2]), ("2025-01-02", [3]), ("2025-01-01", [4])):
        sources.land_records(frame([(v, "x", 2024) for v in values], schema), str(tmp_path / "raw"), day)
    back = sources.with_landing(sources.read_json_records(spark, str(tmp_path / "raw"), schema))
    assert rows(back.select("id", "ingest_date")) == [(3, "2025-01-02"), (4, "2025-01-01")]


def test_csv_files_with_their_own_headers(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,name,size\n1,x,10\n2,\"y, z\",no\nid,name,size\n")
    (tmp_path / "b.csv").write_text("size,id\n30,3\n\n40,4,extra\n50\n")
    (tmp_path / "c.csv").write_text("other\nq\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only-header.csv").write_text("id,size\n")
    found, rejected = sources.split_csv(spark, str(tmp_path), "id int, name string, size int")
    assert found.columns == ["id", "name", "size"]
    expected = [(1, "x", 10), (2, "y, z", None), (None, "name", None), (3, None, 30), (None, None, None)]
    assert rows(found) == sorted(expected, key=repr)
    assert sorted((r["value"], r["file"].rsplit("/", 1)[1]) for r in rejected.collect()) == [("40,4,extra", "b.csv"), ("50", "b.csv")]


def test_csv_folder_without_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    found, rejected = sources.split_csv(spark, str(tmp_path), "id int")
    assert found.collect() == [] and rejected.collect() == [] and found.columns == ["id"]


def test_csv_files_of_several_splits(spark, tmp_path, rows):
    for n, header in enumerate(["id,name", "name,id"]):
        lines = [f"{i},n{i}" if n == 0 else f"n{i},{i}" for i in range(n, 4000, 2)]
        (tmp_path / f"{n}.csv").write_text("\n".join([header, *lines]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        found, rejected = sources.split_csv(spark, str(tmp_path), "id int, name string")
        assert rows(found) == sorted(((i, f"n{i}") for i in range(4000)), key=repr) and rejected.isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_failed_publish_leaves_the_table_as_it_was(spark, frame, tmp_path, rows):
    path = str(tmp_path / "table")
    first = frame([(n, "x") for n in range(50)], "id int, league string").repartition(8)
    sources.publish(first, path, partition_by=("league",))
    reader = sources.read_parquet(spark, path)
    failing = first.withColumn("id", F.expr("IF(id = 40, raise_error('task failed'), id + 1)"))
    with pytest.raises(Exception, match="task failed"):
        sources.publish(failing, path, partition_by=("league",))
    assert sorted(r["id"] for r in sources.read_parquet(spark, path).collect()) == list(range(50))
    sources.publish(first.withColumn("id", F.col("id") * 2), path, partition_by=("league",))
    assert sorted(r["id"] for r in sources.read_parquet(spark, path).collect()) == [2 * n for n in range(50)]
    assert sorted(r["id"] for r in reader.collect()) == list(range(50))  # who reads an older version goes on
    assert len(sources.drop_versions(spark, path)) == 1  # Spark removed what the failed write left
    assert sources.read_parquet(spark, path).count() == 50


def test_counts_of_what_is_written(frame, tmp_path):
    df, seen = sources.counted(frame([(1, None), (2, "b"), (None, None)], "`a.b` int, c string"))
    sources.write_files(df, str(tmp_path / "out"))
    assert seen.get == {"rows": 3, "nonnull.a.b": 2, "nonnull.c": 1}


def test_files_that_are_no_documents_are_set_apart(spark, tmp_path, rows):
    schema = "code string, rows array<struct<id:bigint>>"
    put(tmp_path / "a/one.json", {"code": "x", "rows": [{"id": 1}, {"id": 2}], "more": 1})
    put(tmp_path / "a/two.json", [{"code": "y", "rows": []}, None, {"rows": None}])
    put(tmp_path / "none.json", "[]")
    put(tmp_path / "b/cut.json", '{"code": "z", "rows": [{"id": 3}')
    put(tmp_path / "b/cut-array.json", '[{"code": "z"}, {"code"')
    put(tmp_path / "b/type.json", {"code": "z", "rows": [{"id": "three"}]})
    put(tmp_path / "b/text.json", "not a document")
    put(tmp_path / "b/number.json", "5")
    put(tmp_path / "b/numbers.json", "[5]")
    put(tmp_path / "b/null.json", "null")
    put(tmp_path / "b/blank.json", " \n")
    put(tmp_path / "b/empty.json", "")
    documents, rejected = sources.split_json_documents(spark, str(tmp_path), schema)
    assert documents.columns == ["code", "rows", "file"]
    assert rows(documents.select("code", F.size("rows"))) == sorted([("x", 2), ("y", 0), (None, None)], key=repr)
    names = [r[0] for r in rows(rejected.select(F.substring_index("file", "/", -1)))]
    assert names == ["blank.json", "cut-array.json", "cut.json", "null.json", "number.json", "numbers.json", "text.json", "type.json"]
    assert rows(rejected.where("file like '%text.json'").select("value")) == [("not a document",)]


def test_upserts_rewrite_touched_partitions_only(spark, frame, tmp_path, rows):
    path, schema = str(tmp_path / "table"), "team int, figure int, day string, league string"
    keys = ("team", "league")

    def put_rows(*values):
        return sources.upsert(frame(list(values), schema), path, keys, "day", ("league",))

    def files(league):
        return sorted(p.name for p in (tmp_path / f"table/league={league}").glob("*.parquet"))

    assert put_rows((1, 10, "2025-01-01", "x"), (1, 9, "2024-01-01", "x"), (2, 20, None, "x"), (1, 30, "2025-01-01", "y"), (3, 1, "2025-01-01", None)) == 3
    untouched, replaced = files("y"), files("x")
    assert put_rows((1, 11, "2025-01-01", "x"), (2, 21, "2024-01-01", "x"), (4, 40, "2024-01-01", "x")) == 1
    assert files("y") == untouched and files("x") != replaced
    assert put_rows((1, 0, "2023-01-01", "x"), (3, 2, "2025-02-01", None)) == 2
    found = rows(sources.read_parquet(spark, path).select("team", "figure", "league"))
    assert found == sorted([(1, 11, "x"), (2, 21, "x"), (4, 40, "x"), (1, 30, "y"), (3, 2, None)], key=repr)
    assert put_rows() == 0 and len(rows(sources.read_parquet(spark, path))) == 5
    with pytest.raises(ValueError):
        sources.upsert(frame([], schema), path, ("team",), "day", ("league",))
    version = sources.publish(frame([(1, 1, "d", "x")], schema), str(tmp_path / "whole"))
    with pytest.raises(ValueError):
        sources.upsert(frame([], schema), str(tmp_path / "whole"), keys, "day", ("league",))
    assert version
