from conftest import bag
from dotreef.operators import counts
from dotreef.streaming import refresh_counts

HEAD = "a\nb\nc\nd\n"


def test_landing_folder_is_counted_as_it_fills(spark, tmp_path):
    land = tmp_path / "land"

    def drop(campaign, name, *codes):
        folder = land / "P 1" / campaign
        folder.mkdir(parents=True, exist_ok=True)
        body = "".join(f"{c}.JPG\t{c}\n" for c in codes)
        (folder / f"{name}_Dot Point Measurements.txt").write_text(HEAD + "Filename\tCode\n" + body)

    def run():
        q = refresh_counts(
            spark, str(land), str(tmp_path / "store"), str(tmp_path / "out"),
            lambda df: counts.tally(df, ["campaignid", "code"]),
            checkpoint=str(tmp_path / "cp"), columns=["filename", "code"], files_per_batch=1,
        )
        assert q.awaitTermination(120)
        return bag(spark.read.parquet(str(tmp_path / "out")), "campaignid", "code", "count")

    drop("c1", "one", "1", "1", "2")
    drop("c2", "one", "1")
    assert run() == [("c1", "1", 2), ("c1", "2", 1), ("c2", "1", 1)]
    drop("c1", "two", "2", "3")
    assert run() == [("c1", "1", 2), ("c1", "2", 2), ("c1", "3", 1), ("c2", "1", 1)]
    assert run() == [("c1", "1", 2), ("c1", "2", 2), ("c1", "3", 1), ("c2", "1", 1)]


def test_later_batches_read_no_old_dots(spark, tmp_path):
    """The dots of a finished batch may be gone: totals come from counts."""
    import shutil

    land, store = tmp_path / "land", tmp_path / "store"

    def drop(name, *codes):
        folder = land / "P" / "c"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}_Dot Point Measurements.txt").write_text(HEAD + "Filename\tCode\n" + "".join(f"x\t{c}\n" for c in codes))

    def run():
        q = refresh_counts(
            spark, str(land), str(store), str(tmp_path / "out"), lambda df: counts.tally(df, ["campaignid", "code"]),
            checkpoint=str(tmp_path / "cp"), columns=["filename", "code"],
        )
        assert q.awaitTermination(120)
        return bag(spark.read.parquet(str(tmp_path / "out")), "campaignid", "code", "count")

    drop("one", "1", "2")
    run()
    shutil.rmtree(store / "batch=0")
    drop("two", "2", "3")
    assert run() == [("c", "1", 1), ("c", "2", 2), ("c", "3", 1)]


# --- late, corrected and withdrawn exports ---------------------------------------------------

import os  # noqa: E402
import random  # noqa: E402
import time  # noqa: E402

import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from dotreef.operators import qc  # noqa: E402
from dotreef.sources.ragged import read_annotations, scan_ragged  # noqa: E402
from dotreef.operators.columns import path_columns  # noqa: E402
from dotreef.streaming import FindingsLog, Landing, Levels, deployments, open_findings, watch  # noqa: E402
from dotreef.streaming.levels import sums  # noqa: E402

CODES = lambda df: counts.tally(df, ["campaignid", "code"])


class Box:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.root = spark, tmp_path
        self.land = tmp_path / "land"
        self.land.mkdir()
        self.landing = Landing(spark, str(self.land), str(tmp_path / "store"), CODES, ["filename", "code"], **options)

    def drop(self, campaign, name, codes, days_old=0, project="P 1"):
        folder = self.land / project / campaign
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"{name}_Dot Point Measurements.txt"
        path.write_text(HEAD + "Filename\tCode\n" + "".join(f"{c}.JPG\t{c}\n" for c in codes))
        at = time.time() - 86400 * days_old
        os.utime(path, (at, at))
        return path

    def refresh(self, **how):
        n = self.landing.scan(**how)
        query = self.landing.start(str(self.root / "cp"))
        assert query.awaitTermination(180) and query.exception() is None
        return n

    def now(self):
        found = self.landing.counts()
        return [] if found is None else bag(found, "campaignid", "code", "count")

    def fresh(self):
        """A batch run over what lies in the folder now."""
        if not any(self.land.rglob("*.txt")):
            return []
        raw = read_annotations(self.spark, str(self.land), columns=["filename", "code"])
        return bag(CODES(raw.select("code", *path_columns(F.col("__path"), str(self.land)))), "campaignid", "code", "count")


@pytest.fixture
def box(spark, tmp_path):
    return Box(spark, tmp_path)


def test_exports_with_old_times_are_counted(box):
    box.drop("c", "new", "12")
    box.refresh()
    for days in (3, 9, 30, 4000):
        box.drop("c", f"late{days}", "23", days_old=days)
    assert box.refresh() == 4 and box.now() == box.fresh() == [("c", "1", 1), ("c", "2", 5), ("c", "3", 4)]


def test_corrected_withdrawn_and_restored_exports(box):
    path = box.drop("c", "one", "1122")
    box.drop("007", "two", "19")
    box.refresh()
    box.drop("c", "one", "13", days_old=20)  # replaced by a file with an older time
    box.refresh()
    assert box.now() == box.fresh() == [("007", "1", 1), ("007", "9", 1), ("c", "1", 1), ("c", "3", 1)]
    kept = path.read_text()
    path.unlink()
    assert box.refresh() == 1 and box.now() == box.fresh() == [("007", "1", 1), ("007", "9", 1)]
    assert box.refresh() == 0
    path.write_text(kept)
    box.refresh()
    assert box.now() == box.fresh()
    ledger = {r["path"].rsplit("/", 1)[1]: r for r in box.landing.ledger().collect()}
    assert len(ledger) == 2 and not any(r["gone"] for r in ledger.values())
    assert bag(box.landing.rows(), "campaignid", "code") == [("007", "1"), ("007", "9"), ("c", "1"), ("c", "3")]


def test_touched_files_and_a_recount_change_nothing(box):
    path = box.drop("c", "one", "1122")
    box.refresh()
    before = box.now()
    os.utime(path)
    assert box.refresh() <= 1 and box.now() == before
    assert box.refresh(recount=True) == 1 and box.now() == before
    # The same length and time: only a recount sees it.
    old = path.stat()
    path.write_text(path.read_text().replace("2.JPG\t2", "3.JPG\t3"))
    os.utime(path, ns=(old.st_atime_ns, old.st_mtime_ns))
    assert box.refresh() == 0 and box.now() == before
    box.refresh(recount=True)
    assert box.now() == box.fresh() != before


def test_odd_names_and_files_that_vanish(box):
    for k, name in enumerate(["a [b] {c}", "x*y?", "50% + 1", "äö ü", "back,slash"]):
        box.drop("camp [1]", name, str(k), project="Pro + ject")
    gone = box.drop("c", "short", "7")
    empty = box.drop("c", "empty", "")
    box.landing.scan()
    gone.unlink()  # between the scan and the batch
    assert box.landing.start(str(box.root / "cp")).awaitTermination(180)
    assert box.now() == box.fresh() and len(box.now()) == 5
    assert not box.landing.ledger().filter(F.col("path").endswith("empty_Dot Point Measurements.txt") & ~F.col("gone")).isEmpty()
    empty.unlink()
    box.refresh()
    assert box.now() == box.fresh()


def test_any_history_gives_the_counts_of_a_fresh_run(spark, tmp_path):
    box, rng = Box(spark, tmp_path, files_per_batch=3), random.Random(4)
    box.landing.levels.fan = 2
    for _ in range(5):
        for _ in range(rng.randint(1, 5)):
            action, name = rng.random(), f"f{rng.randint(0, 5)}"
            if action < 0.75:
                box.drop(f"c{rng.randint(0, 2)}", name, [rng.randint(1, 4) for _ in range(rng.randint(0, 6))], days_old=rng.choice([0, 1, 400]))
            else:
                for path in list(box.land.rglob(f"{name}_*"))[:1]:
                    path.unlink()
        box.refresh()
        assert box.now() == box.fresh()


def test_a_campaign_with_nothing_left_goes_from_the_export(spark, tmp_path):
    box = Box(spark, tmp_path, out=str(tmp_path / "out"))
    path = box.drop("only: here", "one", "12")
    box.drop("stays", "one", "1")
    box.refresh()
    read = lambda: bag(spark.read.parquet(str(tmp_path / "out")), "campaignid", "code", "count")
    assert read() == [("only: here", "1", 1), ("only: here", "2", 1), ("stays", "1", 1)]
    path.unlink()
    box.refresh()
    assert read() == [("stays", "1", 1)]


def test_a_batch_that_runs_again_changes_nothing(box):
    box.drop("c", "one", "12")
    box.refresh()
    event = spark_events(box)
    box.landing._on_batch(event, box.landing.levels.state().batch)
    assert box.now() == box.fresh()


def spark_events(box):
    return box.spark.read.schema("path string, length long, time timestamp, gone boolean").option("recursiveFileLookup", "true").parquet(f"{box.landing.store}-feed")


# --- folded batches --------------------------------------------------------------------------


def test_many_batches_are_few_parts_and_readers_see_whole_states(spark, tmp_path):
    levels = Levels(spark, str(tmp_path / "t"), {"counts": sums("count")}, fan=8, keep=3)
    total, most, seen = {}, 0, []
    for b in range(200):
        key = f"k{b % 7}"
        total[key] = total.get(key, 0) + b
        held = levels.read("counts") if b % 50 == 49 else None  # a reader that stays one batch behind
        before = dict(total, **{key: total[key] - b})
        one = spark.range(1).selectExpr(f"'{key}' AS key", f"{b}L AS count")
        levels.commit(b, {"counts": one})
        state = levels.state()
        most = max(most, *[len(p) for p in state.parts.values()])
        seen.append(state.number)
        if held is not None:
            assert {r["key"]: r["count"] for r in held.collect()} == {k: v for k, v in before.items() if v}
            assert {r["key"]: r["count"] for r in levels.read("counts").collect()} == {k: v for k, v in total.items() if v}
    assert most <= 3 * 8 and seen == sorted(set(seen))
    folders = [p for p in (tmp_path / "t" / "counts").iterdir()]
    assert len(folders) <= most + 3 * 8


def test_state_is_published_last(spark, tmp_path, monkeypatch):
    levels = Levels(spark, str(tmp_path / "t"), {"counts": sums("count")}, fan=2)
    one = spark.range(1).selectExpr("'a' AS key", "1L AS count")
    levels.commit(0, {"counts": one})
    monkeypatch.setattr(levels.files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        levels.commit(1, {"counts": one})  # parts are written and folded, the state is not
    again = Levels(spark, str(tmp_path / "t"), {"counts": sums("count")}, fan=2)
    assert again.state().batch == 0 and bag(again.read("counts")) == [("a", 1)]
    assert again.commit(1, {"counts": one}) and not again.commit(1, {"counts": one})
    assert bag(again.read("counts")) == [("a", 2)]


# --- findings --------------------------------------------------------------------------------


def test_open_findings_equal_the_anti_joins_after_any_order(spark, tmp_path):
    land, rng = tmp_path / "land", random.Random(2)
    by = lambda df: counts.tally(df, ["campaignid", "sample"])
    dots = Landing(spark, str(land), str(tmp_path / "dots"), by, ["sample"])
    meta = Landing(spark, str(land), str(tmp_path / "meta"), by, ["sample"], glob="*_Metadata.csv", read=deployments)
    log = FindingsLog(spark, str(tmp_path / "log"))

    def put(campaign, name, samples):
        folder = land / "P" / campaign
        folder.mkdir(parents=True, exist_ok=True)
        head = "Sample\n" if name.endswith(".csv") else HEAD + "Sample\n"
        (folder / name).write_text(head + "".join(f"{s}\n" for s in samples))

    def fresh():
        place = lambda df: df.select("sample", *path_columns(F.col("__path"), str(land)))
        there = lambda end: any(land.rglob(f"*{end}"))
        none = spark.createDataFrame([], "sample string, project string, campaignid string")
        a = place(read_annotations(spark, str(land), columns=["sample"])) if there(".txt") else none
        m = place(scan_ragged(spark, str(land), sep=",", skip=0, columns=["sample"], glob="*_Metadata.csv")) if there(".csv") else none
        one, two = by(qc.annotations_missing_metadata(a, m)), by(qc.metadata_missing_annotations(m, a))
        return sorted([("annotations_missing_metadata", *r) for r in bag(one)] + [("metadata_missing_annotations", *r) for r in bag(two)])

    steps = [("c1", "a_Dot Point Measurements.txt", "1123"), ("c1", "c1_Metadata.csv", "14"), ("c2", "c2_Metadata.csv", "1"), ("c2", "a_Dot Point Measurements.txt", "1"),
             ("c1", "c1_Metadata.csv", "1234"), ("c1", "a_Dot Point Measurements.txt", "24")]
    rng.shuffle(steps)
    for campaign, name, samples in steps:
        put(campaign, name, samples)
        for side in (dots, meta):
            side.scan()
            side.start(f"{side.store}-cp").awaitTermination()
        watch(dots, meta, log)
        assert sorted(tuple(r) for r in log.still_open().select("finding", "campaignid", "sample", "n").collect()) == fresh()
    events = log.events().collect()
    assert any(not e["open"] for e in events) and len({e["look"] for e in events}) > 1


def test_wrong_point_counts_stay_open_until_the_rest_arrives(spark, tmp_path):
    meta = spark.createDataFrame([("c", "s1", "Yes", "Yes", 1), ("c", "s2", "Yes", "No", 1), ("c", "s3", None, "Yes", 1)],
                                 "campaignid string, sample string, successful_habitat_forward string, successful_habitat_backward string, count long")
    log = FindingsLog(spark, str(tmp_path / "log"))
    seen = []
    for dots in ([("c", "s1", 2), ("c", "s2", 2)], [("c", "s1", 4), ("c", "s2", 2), ("c", "s3", 9), (None, "s1", 1)]):
        log.look(open_findings(spark.createDataFrame(dots, "campaignid string, sample string, count long"), meta, per_image=2))
        seen.append(bag(log.still_open(), "finding", "campaignid", "sample", "n"))
    assert seen == [[("metadata_missing_annotations", "c", "s3", 1), ("wrong_point_counts", "c", "s1", 2)], [("annotations_missing_metadata", None, "s1", 1)]]
