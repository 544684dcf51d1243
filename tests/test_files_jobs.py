from pathlib import Path

import pytest

from ratingloom import session
from ratingloom.operators import activity, als, profiling
from ratingloom.plans import evaluate, explore, prepare, recommend, train
from ratingloom.session import shared_folder
from ratingloom.sources import files


def test_quoted_titles(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text('movieId,title,genres\n1,"Say ""Hi"", You (1995)",Comedy|Drama\n2,Plain,\n3,"A, B",(no genres listed)\n')
    rows = [tuple(r) for r in files.read_movies_csv(spark, str(path)).orderBy("movieId").collect()]
    assert rows == [(1, 'Say "Hi", You (1995)', "Comedy|Drama"), (2, "Plain", None), (3, "A, B", "(no genres listed)")]


def test_unreadable_fields_become_null(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text("userId,movieId,rating,timestamp\n1,2,3.5,9\nx,2,bad,9\n")
    rows = [tuple(r) for r in files.read_ratings_csv(spark, str(path)).collect()]
    assert rows == [(1, 2, 3.5, 9), (None, 2, None, 9)]


def test_lines_that_do_not_fit_are_rejected_with_their_reason(spark, tmp_path):
    (tmp_path / "a").mkdir()
    head = "userId,movieId,rating,timestamp\n"
    (tmp_path / "a" / "1.csv").write_text(head + '1,2,3.5,9\nx,2,3,9\n1,2,3\n1,2,3,4,5\n1,2,bad,9\n,2,3,9\n"1","2","3",zz\n\n1,2,3,\n')
    (tmp_path / "a" / "2.csv").write_text(head + "7,2,1e1,9\n99999999999,1,1,1\n1,2,3,4,5,6,7\n")
    good, rejects = files.read_ratings_checked(spark, str(tmp_path / "a"))
    assert sorted(map(str, (tuple(r) for r in good.collect()))) == [
        "(1, 2, 3.0, None)", "(1, 2, 3.5, 9)", "(7, 2, 10.0, 9)", "(None, 2, 3.0, 9)"
    ]
    assert good.select("userId").count() == 4
    found = sorted((r.file[-5:], r.line, r.reason) for r in rejects.collect())
    assert found == [
        ("1.csv", '"1","2","3",zz', "timestamp is no bigint"),
        ("1.csv", "1,2,3", "fewer than 4 fields"),
        ("1.csv", "1,2,3,4,5", "more than 4 fields"),
        ("1.csv", "1,2,bad,9", "rating is no float"),
        ("1.csv", "x,2,3,9", "userId is no int"),
        ("2.csv", "1,2,3,4,5,6,7", "more than 4 fields"),
        ("2.csv", "99999999999,1,1,1", "userId is no int"),
    ]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def stored(spark):
    return set(Path(shared_folder(spark)).glob("*-*"))


def test_temporary_tables_are_deleted_and_others_kept(spark):
    kept = session.durable(spark.range(3), "kept")
    before = stored(spark)
    with session.temporary_tables(spark):
        inner = session.durable(spark.range(5), "inner")
        assert inner.count() == 5 and len(stored(spark) - before) == 1
    with pytest.raises(RuntimeError), session.temporary_tables(spark):
        session.durable(spark.range(5), "inner")
        raise RuntimeError
    assert stored(spark) == before
    assert kept.count() == 3


def test_shuffle_width_follows_the_input_size(spark, monkeypatch):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    table = session.durable(spark.range(100_000), "numbers")
    with session.wide_shuffles(table):
        assert spark.conf.get("spark.sql.shuffle.partitions") == width
    monkeypatch.setattr(session, "_BYTES_PER_TASK", 10_000)
    with session.wide_shuffles(table):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > int(width)
    monkeypatch.setattr(session, "_MAX_SHUFFLE_TASKS", 500)
    monkeypatch.setattr(session, "_BYTES_PER_TASK", 1)
    with pytest.raises(RuntimeError), session.wide_shuffles(table):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "500"
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == width


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    lines = ["userId,movieId,rating,timestamp"]
    for u in range(60):
        for m in range(30):
            if (u * 7 + m * 11) % 3:
                lines.append(f"{u},{m + 1000},{(u + m) % 10 / 2 + 0.5},{u * 131 + m * 17}")
    lines.append("1,1000,9.5,1")
    lines.append("oops,1000,3.0,1")
    (folder / "ratings.csv").write_text("\n".join(lines))
    (folder / "movies.csv").write_text("movieId,title,genres\n" + "\n".join(f'{m + 1000},"T, {m}",G' for m in range(29)))
    (folder / "tags.csv").write_text("userId,movieId,tag,timestamp\n1,1000,fun,1\n2,1001,odd,2\n")
    return folder


def test_jobs_end_to_end(spark, raw, tmp_path):
    data, model, out = str(tmp_path / "data"), str(tmp_path / "model"), str(tmp_path / "out")
    before = stored(spark)
    paths = ["--ratings", f"{raw}/ratings.csv", "--movies", f"{raw}/movies.csv"]

    explore.main([*paths, "--tags", f"{raw}/tags.csv", "--output", f"{out}/explore"])
    counts = {r.name: r.n for r in spark.read.json(f"{out}/explore/table_counts").collect()}
    assert counts == {"movies": 29, "tags": 2}
    assert spark.read.json(f"{out}/explore/missing_ratings").first().asDict() == {"invalid_ratings": 1, "null_ratings": 1}
    assert spark.read.json(f"{out}/explore/top_rated_movies").count() == 10

    prepare.main([*paths, "--output", data])
    splits = files.read_splits(spark, data)
    stats = spark.read.json(f"{data}/dataset_stats").first()
    assert stats.total_ratings == 1200 == sum(s.count() for s in splits.values())
    assert (stats.num_users, stats.num_items) == (60, 30)
    plan = splits["test"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan

    train.main(["--data-dir", data, "--output", out, "--rank", "4", "--max-iter", "3", "--model-path", model, "--save-model", "--full-evaluation"])
    report = {(r.metric, r.segment) for r in spark.read.json(f"{out}/training_metrics").collect()}
    assert {("rmse", "validation"), ("precision", "test"), ("recall", "test"), ("coverage", "train")} <= report
    _, history = als.load_model(spark, model)
    assert history[0]["params"]["rank"] == 4
    assert spark.read.json(f"{out}/bars_by_segment").count() >= 2

    evaluate.main(["--data-dir", data, "--model-path", model, "--output", f"{out}/again"])
    first = {(r.metric, r.segment, r["k"]): r.value for r in spark.read.json(f"{out}/evaluation").collect() if "value" in r}
    again = {(r.metric, r.segment, r["k"]): r.value for r in spark.read.json(f"{out}/again").collect() if "value" in r}
    assert first.keys() == again.keys()
    assert all(first[m] == pytest.approx(again[m]) for m in first)

    clean = spark.read.json(f"{data}/clean_report").first()
    assert (clean.total, clean.out_of_range, clean.missing, clean.kept) == (1202, 1, 1, 1200)
    assert spark.read.json(f"{data}/filter_report").first().removed == 0
    assert {r.split for r in spark.read.json(f"{data}/split_shares").collect()} == {"train", "validation", "test"}
    assert files.read_index(spark, data, "user").count() == 60

    spark.createDataFrame([(0,), (59,), (700,)], "user_id long").write.parquet(str(tmp_path / "requests"))
    recommend.main(["--data-dir", data, "--model-path", model, "--requests", str(tmp_path / "requests"), "--output", f"{out}/recs", "-n", "3", "--exclude-seen"])
    rows = spark.read.parquet(f"{out}/recs").collect()
    assert sorted((r.user_id, r["rank"]) for r in rows if r.status == "success") == [(u, k) for u in (0, 59) for k in (1, 2, 3)]
    assert [r.status for r in rows if r.user_id == 700] == ["user_not_found"]
    assert all(0.5 <= r.predicted_rating <= 5 for r in rows if r.status == "success")
    left = {p.name.split("-")[0] for p in stored(spark) - before}
    assert not left, left


def test_saving_needs_a_path():
    with pytest.raises(SystemExit):
        train.main(["--data-dir", "d", "--output", "o", "--save-model"])


def test_full_evaluation_scores_once(spark, raw, tmp_path, monkeypatch):
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    prepare.main(["--ratings", f"{raw}/ratings.csv", "--movies", f"{raw}/movies.csv", "--output", data])
    calls, score = [], als.top_n_subset
    monkeypatch.setattr(als, "top_n_subset", lambda *args: calls.append(args) or score(*args))
    _, report = train.train(spark, data, out, full_evaluation=True, rank=3, maxIter=2)
    assert len(calls) == 1
    assert dict(report.dtypes) == {"metric": "string", "segment": "string", "k": "int", "value": "double"}
    width = spark.conf.get("spark.sql.shuffle.partitions")
    assert width == "8"


def test_preparation_reads_each_table_for_the_next_one_only(spark, raw, tmp_path, monkeypatch):
    """Reports come from the writes: the raw files are read once, and no written table for a report."""
    plans, reports = [], []
    write = prepare.durable

    def noted(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **kwargs)

    monkeypatch.setattr(prepare, "durable", noted)
    monkeypatch.setattr(prepare.files, "write_json_record", lambda df, path: reports.append(df._jdf.queryExecution().optimizedPlan().toString()))
    prepare.prepare(files.read_ratings_csv(spark, str(raw / "ratings.csv")), files.read_movies_csv(spark, str(raw / "movies.csv")), str(tmp_path))
    assert sum("csv" in plan for plan in plans) == 1 and "CollectMetrics" in plans[0]
    assert len(reports) == 4 and not any("timestamp#" in plan for plan in reports)


def test_statistics_of_counts_equal_those_of_ratings(spark):
    rows = [(u, m, 0.5 + (u * m) % 9 / 2, 1) for u in range(9) for m in range(u + 1)]
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating float, timestamp long")
    whole = profiling.rating_stats(ratings).first()
    counts = activity.rating_counts(ratings)
    expected = profiling.dataset_statistics(ratings).first()
    assert profiling.statistics_of_counts(counts, whole.avg_rating, whole.std_rating).first() == expected
    empty = profiling.statistics_of_counts(counts.limit(0), None, None).first()
    assert empty == profiling.dataset_statistics(ratings.limit(0)).first()


def test_clustered_layout_bounds_files_and_rows_read(spark, tmp_path):
    rows = [(u, i, 1.0, u * 7 + i, u, i, "train" if i % 5 else "test") for u in range(200) for i in range(50)]
    layout = "userId int, movieId int, rating float, timestamp long, user_idx int, item_idx int, split string"
    stored = session.durable(spark.createDataFrame(rows, layout).repartition(16), "indexed")
    files.write_clustered(stored, str(tmp_path), 10)
    parts = list((tmp_path / "ratings_processed").rglob("*.parquet"))
    assert 10 <= len(parts) <= 12
    train = files.read_splits(spark, str(tmp_path))["train"]
    assert train.count() == 200 * 40
    # The statistics of all but one or two files exclude any one user.
    import pyarrow.parquet as pq

    ranges = [pq.ParquetFile(p).metadata.row_group(0).column(4).statistics for p in parts if "split=train" in str(p)]
    assert all(sum(s.min <= u <= s.max for s in ranges) <= 2 for u in range(200))


def test_explore_stores_its_groups_at_the_width_of_the_input(spark, raw, monkeypatch):
    widths = []

    def durable(df, name, partition_by=None):
        widths.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return session.durable(df, name, partition_by)

    monkeypatch.setattr(explore, "durable", durable)
    monkeypatch.setattr(session, "_BYTES_PER_TASK", 1_000)
    ratings = files.read_ratings_csv(spark, f"{raw}/ratings.csv")
    report = explore.explore(ratings, files.read_movies_csv(spark, f"{raw}/movies.csv"), files.read_tags_csv(spark, f"{raw}/tags.csv"))
    assert widths and widths[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert report["totals"].first().total_ratings == 1202
