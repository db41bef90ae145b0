import pytest
from conftest import rows
from pyspark.sql import functions as F

from driftline import schemas
from driftline.plans import graph, messages, names, snowball, topics
from driftline.session import stage, working_path
from driftline.sinks.files import write_csv
from driftline.sources import fixtures, tables


def test_chain_of_jobs(spark, sf, tmp_path):
    """Sample, go on, build the graph, analyse names, all through files."""
    out = str(tmp_path)
    posts, channels = fixtures.posts(spark, sf), fixtures.channels(spark, sf)
    options = {"posts_per_channel": 5}
    first = snowball.run(spark, posts, channels, out, seeds=["@ch_102", "ghost"], max_depth=1, run_id="1", **options)
    assert first.first().seeds == 2
    snowball.run(spark, posts, channels, out, max_depth=3, run_id="2", **options)
    stored = tables.read_channels(spark, f"{out}/snowball_channels")
    assert stored.select("source_file").distinct().count() >= 2
    assert stored.filter("resolution_status = 'seed_unresolved'").count() == 1

    summary = graph.run(spark, f"{out}/snowball_relations", out, run_id="1")
    edges = spark.read.options(header=True).csv(f"{out}/graph/edges")
    assert edges.count() == summary["graph"].first().edges > 0
    nodes = spark.read.options(header=True).csv(f"{out}/graph/nodes")
    assert nodes.count() == summary["graph"].first().nodes

    found = names.run(spark, f"{out}/snowball_channels", out, run_id="1", min_df=1)
    assert found["word_frequency"].count() == found["centrality"].count() > 0
    narrowed = names.run(spark, f"{out}/snowball_channels", out, run_id="2", min_df=1, top_n=4)
    assert narrowed["word_frequency"].count() == 4


def test_message_and_topic_jobs(spark, sf, tmp_path):
    out = str(tmp_path)
    posts = fixtures.messages(spark, sf)
    listed = write_csv(posts.select(F.col("channel_username").alias("username"), F.lit("").alias("title")).distinct(), f"{out}/channels")
    result = messages.run(spark, posts, listed, out, start="2024-01-01", end="2024-01-02", limit=100, run_id="1")
    total = result["totals"].first().messages
    assert total == sum(n for _, n in rows(result["per_channel"])) > 0
    # A second run finds every channel with messages in the trace.
    again = messages.run(spark, posts, listed, out, start="2024-01-01", end="2024-01-02", resume=True, run_id="2")
    assert again["totals"].first().messages == 0
    trace = tables.read_csv(spark, f"{out}/elaborated_channels", schemas.CHANNEL_TRACE)
    assert trace.agg(F.sum("messages_written")).first()[0] == total
    found = topics.run(spark, f"{out}/messages", out, n_topics=2, run_id="1")
    assert found["top_terms"].count() > 0 and found["top_documents"].count() > 0


def test_message_job_checks_its_parameters(spark):
    with pytest.raises(ValueError, match="after"):
        messages.bounds(spark, "2024-02-01", "2024-01-31")
    with pytest.raises(ValueError, match="ISO"):
        messages.bounds(spark, "soon", None)
    with pytest.raises(ValueError, match="limit"):
        messages.run(spark, None, "", "", limit=0)


def test_text_survives_csv(spark, tmp_path):
    texts = ['plain', 'a "quoted" one', "two\nlines\r\nthree", " spaced ", "comma, semi;", "back\\slash", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "message_id long, text string")
    path = write_csv(df, str(tmp_path / "x"), run_id="7")
    assert path.endswith("run_id=7")
    assert dict(rows(tables.read_csv(spark, path, "message_id long, text string"))) == dict(enumerate(texts))


def test_readers_name_missing_columns(spark, tmp_path):
    path = write_csv(spark.range(1).select(F.lit("a").alias("username")), str(tmp_path / "x"))
    with pytest.raises(ValueError, match="missing columns: title"):
        tables.read_channels(spark, path)


def test_no_snapshot(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert tables.latest_snapshot(spark, str(tmp_path / "none")) is None


def test_staged_tables_lie_in_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert folder in working_path(spark, "x")
    assert stage(spark.range(3)).count() == 3


def test_files_with_other_headers_are_read_by_name(spark, tmp_path):
    given = {
        "a.csv": 'username,title,channel_id\n@x,"two\nlines",1\n',
        "b c.csv": "channel_id,extra,title,username\n2,?,T,@y\n",
        "d.csv": "title,username\nonly,@z\n",
    }
    for name, text in given.items():
        (tmp_path / name).write_text(text)
    read = tables.read_channels(spark, str(tmp_path)).select("channel_id", "username", "title")
    assert sorted(map(tuple, read.collect()), key=str) == [(1, "@x", "two\nlines"), (2, "@y", "T"), (None, "@z", "only")]
    (tmp_path / "e.csv").write_text("username\n@q\n")
    with pytest.raises(ValueError, match="missing columns: title in .*e.csv"):
        tables.read_channels(spark, str(tmp_path))


def test_empty_channel_list_is_an_error(spark, tmp_path):
    (tmp_path / "channels").mkdir()
    (tmp_path / "channels" / "a.csv").write_text("username,title\n@,x\n")
    posts = spark.createDataFrame([], "channel_username string, message_id long, date timestamp, text string")
    with pytest.raises(ValueError, match="empty"):
        messages.run(spark, posts, str(tmp_path / "channels"), str(tmp_path / "out"))
