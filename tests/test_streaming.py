import glob
from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tidelog.operators import ORDER, latest_state
from tidelog.plans import catalog, retail
from tidelog.plans import marts as m
from tidelog.plans.catalog import _narrowed, portable
from tidelog.sources import (
    append_log,
    compact_log,
    decode_envelope,
    log_changes,
    overwrite_log,
    read_log,
    valid_events,
    write_messages,
)
from tidelog.quality import cdc_latency, latency_quantiles, latency_summary, log_gaps, merge_latency, offset_gaps
from tidelog.quality.totals import RANK_ERROR
from tidelog.sources.commits import TIER, Committed, Folder, merge_candidates, merged_ranges
from tidelog.sources.log import commit_events, rebuild, write_events
from tidelog.streaming import (
    Kept,
    follow_log,
    keep_history,
    keep_latest,
    keep_summary,
    read_history,
    read_latest,
    read_quarantine,
    read_summary,
    rebuild_log,
    tail,
)


def drain(spark, root):
    query = tail(
        spark,
        {"format": "json", "path": f"{root}/topics"},
        f"{root}/log",
        f"{root}/checkpoint",
        f"{root}/bad",
        batch_limit=1,
    )
    query.awaitTermination()
    return query


def test_tail_resumes_and_loads_every_message_once(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    messages = retail.messages(spark, sf_dir, ["seller", "product", "customer"])
    first = messages.filter("topic NOT LIKE '%customer'")
    write_messages(first, f"{root}/topics", "json", files=3)
    drain(spark, root)
    assert read_log(spark, f"{root}/log").count() == first.count()

    again = drain(spark, root)
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0

    rest = messages.filter("topic LIKE '%customer'")
    broken = rest.limit(1).withColumn("value", F.lit("{")).withColumn("kafka_offset", F.lit(-1))
    write_messages(rest.unionByName(broken), f"{root}/topics", "json", files=1)
    drain(spark, root)
    log = read_log(spark, f"{root}/log")
    assert log.count() == messages.count()
    assert log.select("topic", "partition", "kafka_offset").distinct().count() == log.count()
    bad = read_quarantine(spark, f"{root}/log", f"{root}/bad")
    assert [r["problem"] for r in bad.collect()] == ["malformed message"]


def test_rebuild_equals_the_tailed_log(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    write_messages(retail.messages(spark, sf_dir, ["seller"]), f"{root}/topics", "json", files=2)
    drain(spark, root)
    tailed = rows(read_log(spark, f"{root}/log").drop("batch"))
    rebuild_log(spark, {"format": "json", "path": f"{root}/topics"}, f"{root}/log", f"{root}/bad")
    assert rows(read_log(spark, f"{root}/log").drop("batch")) == tailed


POSITIONS = ("topic", "partition", "kafka_offset")


def holds_once(spark, root, messages):
    log = read_log(spark, f"{root}/log")
    assert log.count() == log.select(*POSITIONS).distinct().count() == messages
    return log


def add(messages, root, n):
    write_messages(messages.filter(F.col("kafka_offset") % 4 == n), f"{root}/topics", "json", files=1)


def test_writers_leave_each_other_alone(spark, sf_dir, tmp_path):
    """tail, append, tail; then a rebuild with a broken message, the old, a new and a lost checkpoint."""
    root = str(tmp_path)
    messages = retail.messages(spark, sf_dir, ["product"]).persist()
    count = lambda *n: messages.filter((F.col("kafka_offset") % 4).isin(*n)).count()
    events = lambda n: valid_events(decode_envelope(messages.filter(F.col("kafka_offset") % 4 == n)))
    add(messages, root, 0)
    drain(spark, root)
    append_log(events(1).union(events(1)), f"{root}/log")
    append_log(events(0), f"{root}/log")
    holds_once(spark, root, count(0, 1))
    add(messages, root, 2)
    drain(spark, root)
    holds_once(spark, root, count(0, 1, 2))

    add(messages.limit(1).withColumns({"value": F.lit("{"), "kafka_offset": F.lit(1_000_000)}), root, 0)
    source = {"format": "json", "path": f"{root}/topics"}
    rebuild_log(spark, source, f"{root}/log", f"{root}/bad")
    holds_once(spark, root, count(0, 2))
    assert read_quarantine(spark, f"{root}/log", f"{root}/bad").count() == 1
    add(messages, root, 3)
    drain(spark, root)
    holds_once(spark, root, count(0, 2, 3))
    for checkpoint in ("new", "lost"):
        tail(spark, source, f"{root}/log", f"{root}/{checkpoint}", f"{root}/bad").awaitTermination()
        holds_once(spark, root, count(0, 2, 3))
    add(messages, root, 1)
    drain(spark, root)
    holds_once(spark, root, messages.count())
    assert read_quarantine(spark, f"{root}/log", f"{root}/bad").count() == 1


@pytest.fixture(scope="module")
def sellers(spark, sf_dir):
    """Events of one table, with offsets 0, 1, 2 ..."""
    events = valid_events(decode_envelope(retail.messages(spark, sf_dir, ["product"])))
    dense = F.row_number().over(Window.orderBy("kafka_offset")) - 1
    return events.withColumn("kafka_offset", dense.cast("bigint")).withColumn("lsn", F.col("kafka_offset")).persist()


def test_a_failed_rebuild_changes_nothing(spark, sellers, tmp_path):
    path = f"{tmp_path}/log"
    append_log(sellers, path)

    def dies():
        write_events(sellers.limit(2), path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        rebuild(spark, path, dies)
    assert read_log(spark, path).count() == sellers.count()
    overwrite_log(sellers.where("kafka_offset < 5"), path)
    assert read_log(spark, path).count() == 5


def test_a_writer_that_dies_before_its_commit_leaves_nothing(spark, sellers, tmp_path):
    path = f"{tmp_path}/log"
    append_log(sellers.where("kafka_offset < 9"), path)
    write_events(sellers, path)
    assert read_log(spark, path).count() == 9
    append_log(sellers, path)
    assert rows(read_log(spark, path)) == rows(sellers)


def test_writers_at_once_give_each_message_once(spark, sellers, tmp_path):
    """Six writers with overlapping messages, all written before any commits."""
    path = f"{tmp_path}/log"
    parts = [sellers.where(F.col("kafka_offset").between(20 * i, 20 * i + 60)) for i in range(5)]
    names = [write_events(p, path) for p in [*parts, sellers]]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: commit_events(spark, path, names[i], f"w{i}", 0), range(6)))
    assert rows(read_log(spark, path)) == rows(sellers)


def test_one_of_two_commits_of_a_version_wins(spark, tmp_path):
    table = Committed(spark, f"{tmp_path}/table")
    seen = table.newest()
    won = [table.publish(seen, added=[Folder(None, "w", i, 0, side=(str(i),))]) for i in range(3)]
    assert [bool(w) for w in won] == [True, False, False]
    assert table.newest() == won[0] and table.version(1).added[0].side == ("0",)


def test_a_lost_or_late_hint_changes_nothing(spark, tmp_path):
    table = Committed(spark, f"{tmp_path}/table")
    for i in range(4):
        table.publish(table.newest(), added=[Folder(None, "w", i, 0)])
    for hint in ("1", "0", "", "x", "77"):
        (tmp_path / "table" / "_newest").write_text(hint)
        (tmp_path / "table" / "._newest.crc").unlink(missing_ok=True)
        assert table.newest().number == 4


def test_what_is_committed_during_a_rebuild_stays(spark, sellers, tmp_path):
    path = f"{tmp_path}/log"
    part = lambda a, b: sellers.where(F.col("kafka_offset").between(a, b))
    append_log(part(0, 19), path)
    append_log(part(150, 159), path)

    def write():
        name = write_events(part(0, 24), path)
        append_log(part(20, 29), path, 0, "stream")  # half of it is in the rebuild
        for i in range(30, 30 + TIER):
            append_log(part(i, i), path, i, "stream")
        compact_log(spark, path)
        return name, ()

    after = rebuild(spark, path, write)
    # what was there before and is not in the rebuild is gone
    assert rows(read_log(spark, path)) == rows(part(0, 29 + TIER))
    assert after.generation == 1 and after.fences == ()
    append_log(sellers, path)
    assert rows(read_log(spark, path)) == rows(sellers)


def test_two_rebuilds_at_once_are_refused(spark, sellers, tmp_path):
    path = f"{tmp_path}/log"

    def write():
        overwrite_log(sellers.limit(3), path)
        return write_events(sellers, path), ()

    with pytest.raises(RuntimeError, match="another writer"):
        rebuild(spark, path, write)
    assert read_log(spark, path).count() == 3


def test_a_commit_opens_as_many_files_however_many_came_before(spark, sellers, tmp_path):
    """The folders of a version and the looks of a commit stay the same; results equal before and after."""
    path = f"{tmp_path}/log"
    table = Committed(spark, path)
    few = {}
    for i in range(4 * TIER):
        append_log(sellers.where(f"kafka_offset % {4 * TIER} = {i}"), path, i, "w")
        before = rows(read_log(spark, path)) if i == TIER else None
        compact_log(spark, path)
        assert before is None or rows(read_log(spark, path)) == before
        looks = []
        counted = Committed(spark, path)
        counted.exists, counted._listed = (lambda f, own=counted.exists: looks.append(f) or own(f)), lambda: 1 / 0
        few[i] = (len(counted.newest().folders), len(looks))
    assert max(n for n, _ in few.values()) <= 3 * TIER
    assert few[TIER][1] == few[4 * TIER - 1][1] <= 6
    assert rows(read_log(spark, path)) == rows(sellers)
    # merged folders are named by old versions only
    assert table.remove_unnamed(keep=1, older_than_ms=0) > 2 * TIER
    assert rows(read_log(spark, path)) == rows(sellers)
    append_log(sellers, path)
    assert rows(read_log(spark, path)) == rows(sellers)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60), st.integers(1, 9)), max_size=40))
def test_merged_ranges_hold_the_same_offsets(pieces):
    taken, folders = set(), []
    for partition, low, size in pieces:
        own = {(partition, o) for o in range(low, low + size)} - taken
        taken |= own
        if own:
            offsets = [o for _, o in own]
            folders.append(Folder("x", "w", 0, len(own), ranges=(("t", partition, min(offsets), max(offsets), len(own)),)))
    out = merged_ranges(folders)
    assert sum(r[4] for r in out) == len(taken)
    assert all(any(p == r[1] and r[2] <= o <= r[3] for r in out) for p, o in taken)
    for _, partition, low, high, n in out:
        if n == high - low + 1:
            assert {(partition, o) for o in range(low, high + 1)} <= taken


def test_merges_do_not_cross_a_fence():
    folders = [Folder(str(i), "w", i, 3, since=i) for i in range(1, 2 * TIER)]
    from tidelog.sources.commits import Version

    assert len(merge_candidates(Version(99, folders=tuple(folders)))) == 2 * TIER - 1
    assert merge_candidates(Version(99, folders=tuple(folders), fences=(TIER,))) == folders[:TIER]


def test_gaps_from_ranges_equal_gaps_of_rows(spark, sellers, tmp_path):
    path = f"{tmp_path}/log"
    kept = sellers.where("kafka_offset NOT IN (3, 4, 9) AND kafka_offset NOT BETWEEN 40 AND 70")
    for condition in ("kafka_offset < 3", "kafka_offset BETWEEN 5 AND 8", "kafka_offset BETWEEN 10 AND 39", "kafka_offset > 70"):
        append_log(kept.where(condition), path)
    columns = ["topic", "partition", "previous", "kafka_offset", "missing"]
    found = rows(log_gaps(spark, path))
    assert found == rows(offset_gaps(read_log(spark, path)).select(columns)) and [r[4] for r in found] != []
    # nothing but the version was read
    assert "FileScan" not in log_gaps(spark, path)._jdf.queryExecution().executedPlan().toString()
    append_log(sellers.where("kafka_offset IN (50, 60)"), path)
    assert rows(log_gaps(spark, path)) == rows(offset_gaps(read_log(spark, path)).select(columns))


def test_changes_of_the_log(spark, sellers, tmp_path):
    path = f"{tmp_path}/log"
    append_log(sellers.where("kafka_offset < 5"), path)
    version, found, anew = log_changes(spark, path, 0)
    assert (found.count(), anew) == (5, False)
    assert log_changes(spark, path, version) == (version, None, False)
    for i in range(5, 5 + TIER):
        append_log(sellers.where(f"kafka_offset = {i}"), path)
    compact_log(spark, path)
    later, found, anew = log_changes(spark, path, version)
    assert (found.count(), anew) == (TIER, False)
    overwrite_log(sellers.where("kafka_offset < 2"), path)
    _, found, anew = log_changes(spark, path, later)
    assert (found.count(), anew) == (2, True)


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    log = retail.landed_log(spark, sf_dir, ["order"], deletes=True)["order"]
    return m.order_events(log)


def ddl(df):
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


@pytest.mark.parametrize("split", ["kafka_offset", "hash(order_id, kafka_offset, 7)"])
def test_history_kept_by_batches_equals_the_whole(spark, staged, tmp_path, split):
    """Whatever the split, and with a batch run twice as after a crash."""
    root = str(tmp_path)
    parts = [staged.filter(F.expr(f"pmod({split}, 3)") == i) for i in range(3)]
    build = m.dim_order_status_history
    for i in (0, 1, 1, 2, 0):
        keep_history(parts[i], i, root, ["order_id"], build, buckets=4)
    whole = build(staged)
    assert rows(read_history(spark, root, ddl(whole), ["order_id"])) == rows(whole)


def test_latest_kept_by_batches_equals_the_whole(spark, staged, tmp_path):
    root = str(tmp_path)
    # newest events first: late ones must not win over a newer delete
    parts = [staged.filter(F.col("kafka_offset") % 8 >= 4), staged.filter(F.col("kafka_offset") % 8 < 4)]
    for i in (0, 0, 1, 1):
        keep_latest(parts[i], i, root, ["order_id"], ORDER, buckets=4)
    whole = latest_state(staged, ["order_id"], ORDER)
    assert rows(read_latest(spark, root, ddl(staged), ["order_id"], ORDER)) == rows(whole)


def test_many_batches_are_merged_and_equal_the_whole(spark, staged, tmp_path):
    build = m.dim_order_status_history
    n = TIER + 2
    for i in range(n):
        part = staged.filter(F.expr(f"pmod(hash(order_id, kafka_offset), {n})") == i)
        keep_latest(part, i, f"{tmp_path}/latest", ["order_id"], ORDER, buckets=2)
        keep_history(part, i, f"{tmp_path}/history", ["order_id"], build, buckets=2)
    for table in ("latest", "history/events", "history/versions"):
        assert len(Committed(spark, f"{tmp_path}/{table}").newest().folders) < n
    assert rows(read_latest(spark, f"{tmp_path}/latest", ddl(staged), ["order_id"], ORDER)) == rows(
        latest_state(staged, ["order_id"], ORDER)
    )
    whole = build(staged)
    assert rows(read_history(spark, f"{tmp_path}/history", ddl(whole), ["order_id"])) == rows(whole)


def test_a_batch_writes_in_proportion_to_its_keys(spark, staged, tmp_path):
    """One order's event: one row of latest state, the versions of that order, whatever lies there."""
    build = m.dim_order_status_history
    last = staged.where("order_id = '5'").orderBy(F.desc("kafka_offset")).limit(1)
    rest = staged.join(last.select("kafka_offset"), "kafka_offset", "left_anti")
    keep_latest(rest, 0, f"{tmp_path}/latest", ["order_id"], ORDER)
    keep_history(rest, 0, f"{tmp_path}/history", ["order_id"], build)
    keep_latest(last, 1, f"{tmp_path}/latest", ["order_id"], ORDER)
    keep_history(last, 1, f"{tmp_path}/history", ["order_id"], build)
    added = {t: Committed(spark, f"{tmp_path}/{t}").newest().added[0].rows for t in ("latest", "history/events", "history/versions")}
    own = build(staged.where("order_id = '5'")).count()
    assert added == {"latest": 1, "history/events": 1, "history/versions": own}
    folder = Committed(spark, f"{tmp_path}/latest").newest().added[0].name
    assert len([p for p in (tmp_path / "latest" / "data" / f"commit={folder}").iterdir() if p.name.startswith("bucket")]) == 1
    assert read_latest(spark, f"{tmp_path}/latest", ddl(staged), ["order_id"], ORDER).count() == 1493


def test_an_empty_batch_changes_nothing(spark, staged, tmp_path):
    root = str(tmp_path)
    for i, part in enumerate((staged.filter("false"), staged, staged.filter("false"))):
        keep_latest(part, i, f"{root}/latest", ["order_id"], ORDER, buckets=4)
        keep_history(part, i, f"{root}/history", ["order_id"], m.dim_order_status_history, buckets=4)
    assert read_latest(spark, f"{root}/latest", ddl(staged), ["order_id"], ORDER).count() == 1493
    whole = m.dim_order_status_history(staged)
    assert rows(read_history(spark, f"{root}/history", ddl(whole), ["order_id"])) == rows(whole)


def test_states_follow_the_current_generation_only(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/log"
    events = valid_events(decode_envelope(retail.table_messages(spark, sf_dir, "order", deletes=True))).persist()
    kept = {
        "history": Kept(m.order_events, ["order_id"], build=m.dim_order_status_history),
        "latest": Kept(m.order_events, ["order_id"], ORDER),
    }

    def holds(log):
        staged = m.order_events(log)
        want = {"history": m.dim_order_status_history(staged), "latest": latest_state(staged, ["order_id"], ORDER)}
        for name, state in kept.items():
            assert rows(state.read(spark, f"{tmp_path}/state/{name}", log)) == rows(want[name])

    append_log(events.where("kafka_offset % 2 = 0"), path)
    follow_log(spark, path, f"{tmp_path}/state", kept)
    holds(read_log(spark, path))
    append_log(events.where("kafka_offset % 4 = 1"), path)
    assert follow_log(spark, path, f"{tmp_path}/state", kept) == follow_log(spark, path, f"{tmp_path}/state", kept)
    holds(read_log(spark, path))
    overwrite_log(events.where("kafka_offset % 4 = 1"), path)
    follow_log(spark, path, f"{tmp_path}/state", kept)
    holds(events.where("kafka_offset % 4 = 1"))
    append_log(events, path)
    follow_log(spark, path, f"{tmp_path}/state", kept)
    holds(events)


def test_latency_summaries_merge_to_exact_totals_and_close_quantiles(spark, staged, tmp_path):
    n = TIER + 2
    for i in range(n):
        part = staged.filter(F.expr(f"pmod(hash(kafka_offset), {n})") == i)
        keep_summary(part, i, str(tmp_path), latency_summary, merge_latency)
        keep_summary(part, i, str(tmp_path), latency_summary, merge_latency)
    keep_summary(staged.limit(0), n, str(tmp_path), latency_summary, merge_latency)
    assert len(Committed(spark, str(tmp_path)).newest().folders) < n
    kept = latency_quantiles(read_summary(spark, str(tmp_path), ddl(latency_summary(staged)), merge_latency))
    exact = {}
    for r in staged.filter("changed_at IS NOT NULL").select("op", F.expr("unix_millis(event_at) - unix_millis(changed_at) AS ms")).collect():
        exact.setdefault(r.op, []).append(r.ms)
    rows_ = {r.op: r for r in kept.collect()}
    assert set(rows_) == set(exact)
    for op, ms in exact.items():
        r = rows_[op]
        assert (r.events, r.min_ms, r.max_ms, r.sum_ms) == (len(ms), min(ms), max(ms), sum(ms))
        for got, rank in ((r.p50_ms, 0.5), (r.p95_ms, 0.95), (r.p99_ms, 0.99)):
            assert sum(x < got for x in ms) / len(ms) <= rank + RANK_ERROR
            assert sum(x <= got for x in ms) / len(ms) >= rank - RANK_ERROR


def test_delays_that_add_up_to_more_than_64_bits(spark, tmp_path):
    # each delay is 9.2e15 ms, the widest a timestamp can say; a read is as short as delays are
    events = spark.range(2001).selectExpr(
        "if(id < 2000, 'update', 'read') AS op",
        "timestamp_micros(if(id < 2000, 9200000000000000000, 5000)) AS event_at",
        "timestamp_micros(0L) AS changed_at",
    )
    total = {"update": 2000 * 92 * 10**14, "read": 5}
    halves = [latency_summary(events.where(f"hash(event_at, op) % 2 {sign} 0")) for sign in ("=", "<>")]
    merged = merge_latency(halves[0].unionByName(halves[1]))
    for found in (cdc_latency(events), latency_summary(events), merged):
        assert {r.op: int(r.sum_ms) for r in found.collect()} == total
    wide = portable(_narrowed(cdc_latency(events), "sum_ms"))
    assert {r.op: int(r.sum_ms) for r in wide.collect()} == total
    small = _narrowed(cdc_latency(events.where("op = 'read'")), "sum_ms")
    assert dict(small.dtypes)["sum_ms"] == "bigint" and small.first().sum_ms == 5
    # a summary that was kept with sums of 64 bits is read like others
    kept = latency_summary(events.where("op = 'read'"))
    kept.withColumn("sum_ms", F.col("sum_ms").cast("bigint")).write.parquet(f"{tmp_path}/old")
    again = merge_latency(spark.read.schema(kept.schema).parquet(f"{tmp_path}/old"))
    assert [int(r.sum_ms) for r in again.collect()] == [5]


def some_orders(spark, path, files):
    """An orders table of a few rows, one with a negative key and one without, in as many files."""
    keys = spark.range(-1, 201).select(F.nullif("id", F.lit(0)).alias("id"))
    orders = keys.selectExpr(
        "id AS o_orderkey",
        "id % 7 AS o_custkey",
        "substring('FOP', cast(pmod(id, 3) + 1 AS int), 1) AS o_orderstatus",
        "timestamp_seconds(800000000 + coalesce(id, 0) * 86400) AS o_orderdate",
    )
    orders.repartition(files).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_message_files_grow_with_the_messages_and_batches_do_not(spark, tmp_path):
    """A fixed number of files would put a fixed share of all messages into one task."""
    given = some_orders(spark, tmp_path, files=5)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        root = catalog._streamed(spark, given, ["order"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(glob.glob(f"{root}/topics/*.parquet")) >= 15
    assert len(glob.glob(f"{root}/checkpoint/commits/[0-9]*")) == 3
    wanted = retail.table_messages(spark, given, "order", deletes=True).count()
    assert spark.read.parquet(f"{root}/topics").count() == wanted


def test_rows_are_not_sorted_by_the_folders_they_are_written_to(spark, tmp_path):
    """Such a sort holds, or spills, all rows of a task with their images."""
    spark.sql(f"CREATE TABLE by_kind (v bigint, kind string) USING parquet PARTITIONED BY (kind) LOCATION '{tmp_path}/t'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO by_kind SELECT id, concat('k', id % 2) FROM range(10)").first()[0]
    finally:
        spark.sql("DROP TABLE by_kind")
    assert "Sort" not in plan


def test_folders_of_the_log_are_packed_tightly(spark, tmp_path):
    messages = retail.messages(spark, some_orders(spark, tmp_path, files=1), ["order"])
    append_log(valid_events(decode_envelope(messages)), f"{tmp_path}/log")
    files = glob.glob(f"{tmp_path}/log/data/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)
