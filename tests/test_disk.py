"""What a step shuffled or wrote for itself goes as soon as it has been used."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from cartwheel.plans import preparation
from cartwheel.session import SHUFFLES_GO, scratch_folder, settle
from conftest import rows


def shuffle_files(spark) -> int:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(i).isShuffle() for i in range(blocks.size()))


def test_settled_rows_leave_no_shuffle(spark):
    before, kept = shuffle_files(spark), spark.conf.get(SHUFFLES_GO, None)
    counted = settle(spark.range(1000).groupBy(F.col("id") % 7).agg(F.sum("id").alias("n")), scratch_folder(spark, "test"))
    assert spark.conf.get(SHUFFLES_GO, None) == kept
    for _ in range(100):        # files go a moment later
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert counted.agg(F.sum("n")).first()[0] == 499_500


def test_parts_of_the_events_are_all_events(spark, monkeypatch):
    lines = spark.createDataFrame(
        [(str(i % 40), f"P{i % 5}", f"name {i % 5}", 1 if i % 4 else -1, f"1/{i % 9 + 1}/2024 9:05", 9.5, None if i % 11 == 0 else i % 6, "Korea")
         for i in list(range(120)) + [7] * 30],
        "invoice_no string, stock_code string, description string, quantity int, invoice_date string, unit_price double,"
        " customer_id long, country string")
    made = preparation.prepare(lines)
    sizes = []

    def total(events):
        sizes.append(events.count())
        return events

    whole = rows(made.events)
    monkeypatch.setattr(preparation, "PART_PURCHASES", 30)
    assert rows(preparation.event_totals(made, total)) == whole
    assert len(sizes) > 2 and max(sizes) < len(whole) and sum(sizes) == len(whole)


def test_line_dedup_keeps_only_what_its_result_reads(spark):
    import random

    from cartwheel.llm import line_dedup
    rng = random.Random(5)
    line = lambda: "".join(rng.choice("abcdefgh ") for _ in range(80))
    base = [line() for _ in range(30)]
    docs = spark.createDataFrame([(i, "\n".join([line(), base[i % 30][:40] + rng.choice("xyz") + base[i % 30][41:]]))
                                  for i in range(90)], "doc_id long, text string")
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark, "x")).getParent()
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders():
        return {f.getPath().getName() for f in store.listStatus(root)} if store.exists(root) else set()

    before = folders()
    out = line_dedup.dedup_lines(docs)
    left = folders() - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["llm-gone-lines"]
    assert out.agg(F.sum("n_removed")).first()[0] == 60


def test_keys_of_the_two_ends_are_dealt_apart():
    """Entries of one end of the lines, then of the other, are all entries: each shelf is dealt on its own."""
    import random

    import numpy as np

    from cartwheel.llm import line_dedup
    rng = random.Random(6)
    lines = sorted({"".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 700))) for _ in range(300)})
    named = lambda e: sorted(zip(*(e[c].tolist() for c in ("key", "line", "filed", "tall", "near"))))
    whole, ends = line_dedup.entries(lines), [line_dedup.entries(lines, (shelf,)) for shelf in (0, line_dedup.PLACES)]
    assert named(whole) == sorted(named(ends[0]) + named(ends[1]))
    assert max(len(e["key"]) for e in ends) < 0.7 * len(whole["key"])
    assert not np.isin(ends[0]["key"], ends[1]["key"]).any()
