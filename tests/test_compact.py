"""Incremental compaction, indexed lookups and admission control."""
import os
import random

import pytest
from pyspark.sql import functions as F

from ratewise import __main__ as cli
from ratewise.operators import compact, report, serve
from ratewise.session import remove_path
from ratewise.sinks.writers import write_batch_lists
from ratewise.sources import store
from ratewise.streaming.scoring import SourceConfig, kafka_source, read_messages

SCHEMA = "user_idx int, recommendations array<struct<product_idx:int,rating:float>>"


def _batch(spark, users, tag):
    return spark.createDataFrame([(u, [(1000 * tag + u, float(tag)), (u, 0.5)]) for u in users], SCHEMA)


def _lists(df):
    return sorted((r.user_idx, r.batch_id, [(e.product_idx, e.rating) for e in r.recommendations]) for r in df.collect())


def _full(spark, path):
    return _lists(serve.latest_lists(store.read_store(spark, path), store.STORE_ORDER))


def test_folding_step_by_step_equals_the_full_reduction(spark, tmp):
    lists, root = tmp + "/lists", tmp + "/compacted"
    rnd = random.Random(3)
    assert compact.current_lists(spark, lists, root).count() == 0
    for b in range(4):
        write_batch_lists(_batch(spark, sorted(rnd.sample(range(40), 12)), b), lists, b, "run1")
        assert _lists(compact.current_lists(spark, lists, root)) == _full(spark, lists)  # with a file not folded
        gen = compact.fold_new(spark, lists, root, block=8)
        assert gen.number == b and _lists(compact.current_lists(spark, lists, root)) == _full(spark, lists)
    assert compact.fold_new(spark, lists, root, block=8).number == 3  # nothing new, no new generation
    assert [g.number for g in compact.generations(spark, root)] == [2, 3]
    # an older run that becomes visible late, and a replayed batch
    write_batch_lists(_batch(spark, [0, 1, 41], 9), lists, 7, "run0")
    write_batch_lists(_batch(spark, [2, 3], 8), lists, 3, "run1")
    write_batch_lists(_batch(spark, [5], 7), lists, 0, "run2")
    compact.fold_new(spark, lists, root, block=8)
    got = {u: (b, r) for u, b, r in _lists(compact.current_lists(spark, lists, root))}
    assert got[41][0] == 7 and got[5] == (0, [(7005, 7.0), (5, 0.5)]) and got[2][1][0][0] == 8002


def test_only_new_files_are_read(spark, tmp):
    """Folded files can go: later folds and reads don't touch them."""
    lists, root = tmp + "/lists", tmp + "/compacted"
    write_batch_lists(_batch(spark, range(10), 1), lists, 1)
    compact.fold_new(spark, lists, root)
    remove_path(spark, lists + "/batch_id=1")
    write_batch_lists(_batch(spark, [3], 2), lists, 2)
    compact.fold_new(spark, lists, root)
    got = {u: b for u, b, _ in _lists(compact.current_lists(spark, lists, root))}
    assert got == {u: 2 if u == 3 else 1 for u in range(10)}


def test_unfinished_generation_is_not_used(spark, tmp):
    lists, root = tmp + "/lists", tmp + "/compacted"
    write_batch_lists(_batch(spark, range(4), 0), lists, 0)
    compact.fold_new(spark, lists, root)
    write_batch_lists(_batch(spark, range(2), 1), lists, 1)
    dead = compact.fold_new(spark, lists, root)
    remove_path(spark, dead.folded + "/_SUCCESS")  # as if the job had died before its last step
    assert [g.number for g in compact.generations(spark, root)] == [0]
    assert _lists(compact.current_lists(spark, lists, root)) == _full(spark, lists)
    again = compact.fold_new(spark, lists, root)
    assert again.number == 1 and _lists(compact.current_lists(spark, lists, root)) == _full(spark, lists)


def _files_read(df):
    """Number of files the scan opened."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    todo = [node]
    while todo:
        n = todo.pop()
        if n.nodeName().startswith("Scan parquet"):
            return int(n.metrics().apply("numFiles").value())
        if n.nodeName() == "AdaptiveSparkPlan":
            todo.append(n.executedPlan())
        children = n.children()
        todo += [children.apply(i) for i in range(children.size())]
    raise AssertionError("no scan")


def test_point_lookup_opens_one_folder(spark, tmp):
    lists, root = tmp + "/lists", tmp + "/compacted"
    write_batch_lists(_batch(spark, range(64), 0), lists, 0)
    gen = compact.fold_new(spark, lists, root, block=4)
    every = _files_read(compact.lists_table(spark, gen).select("user_idx"))
    found = compact.point_lookup(spark, gen, 37)
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(user_block" in plan and "EqualTo(user_idx,37)" in plan
    assert [r.user_idx for r in found.collect()] == [37]
    assert every >= 16 and _files_read(compact.point_lookup(spark, gen, 37).select("user_idx")) <= 2
    assert compact.point_lookup(spark, gen, 64).count() == 0
    requests = spark.createDataFrame([(5, 3), (6, None), (999, 1)], "user_id int, n int")
    pruned = compact.lookup_lists(spark, gen, requests)
    assert _files_read(pruned.select("user_idx")) <= 2
    full = serve.latest_lists(store.read_store(spark, lists), store.STORE_ORDER)
    rows = lambda x: sorted(map(str, serve.lookup(requests, x).collect()))
    assert rows(pruned) == rows(full)


def test_records_read_the_compacted_table(spark, tmp):
    lists, root = tmp + "/lists", tmp + "/compacted"
    assert report.health(spark, lists, root).first().utilisateurs_en_cache == 0
    write_batch_lists(_batch(spark, range(6), 0), lists, 0)
    compact.fold_new(spark, lists, root)
    write_batch_lists(_batch(spark, [5, 6], 1), lists, 1)
    for folder in (None, root):
        h = report.health(spark, lists, folder).first()
        assert h.utilisateurs_en_cache == 7 and h.fichiers_trouves == store.count_files(spark, lists)
        s = report.stats(spark, lists, tmp + "/none", tmp + "/none", folder).first()
        assert s.total_utilisateurs_avec_recommandations == 7


def test_limits_of_sources():
    topic = kafka_source("h:1", starting="earliest").limited(offsets=500, least_offsets=20, longest_delay="2m")
    assert topic.options["maxOffsetsPerTrigger"] == "500" and topic.options["minOffsetsPerTrigger"] == "20"
    assert topic.options["maxTriggerDelay"] == "2m" and topic.options["startingOffsets"] == "earliest"
    folder = SourceConfig(path="/x")
    assert folder.limited().options == {"maxFilesPerTrigger": "1"}
    assert folder.limited(size="1m").options == {"maxBytesPerTrigger": "1m"} and folder.options == {}
    for wrong in (dict(offsets=1), dict(files=0), dict(files=1, size=1)):
        with pytest.raises(ValueError):
            folder.limited(**wrong)
    with pytest.raises(ValueError):
        kafka_source("h:1").limited(files=1)
    args = cli.parser().parse_args("stream --model m --users u --out o --checkpoint c --kafka h:1 --offsets-per-batch 7".split())
    assert args.offsets_per_batch == 7
    assert cli.parser().parse_args("stream --model m --users u --out o --checkpoint c --kafka h:1".split()).offsets_per_batch > 0


@pytest.mark.parametrize("limit,most", [(dict(files=3), 3), (dict(size=1), 1), (dict(), 1)])
def test_backlog_arrives_in_bounded_batches(spark, tmp, limit, most):
    """Ten files wait; no micro-batch takes more than the limit, none is lost."""
    inbox = tmp + "/inbox"
    os.makedirs(inbox)
    for i in range(10):
        with open(f"{inbox}/{i}.json", "w") as f:
            f.write('{"UserId": "U%d", "ProductId": "P", "Score": 1.0, "Time": 1}\n' % i)
    seen = []
    q = (read_messages(spark, SourceConfig(path=inbox).limited(**limit)).writeStream
         .foreachBatch(lambda df, i: seen.append(sorted(r.UserId for r in df.collect())))
         .option("checkpointLocation", tmp + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None and max(map(len, seen)) <= most
    assert sorted(sum(seen, [])) == sorted(f"U{i}" for i in range(10))
