"""The partitioned store: touched partitions, puts, ledger, expiry, conflicts."""

import pytest
from pyspark.sql import functions as F

from decreta.sources import store as store_module
from decreta.sources.store import Store
from decreta.streaming import jobs as J


def rows_of(spark, pairs):
    return spark.createDataFrame([(f"{o}-{i}", o, v) for i, (o, v) in enumerate(pairs)], "id string, order_id string, sport string")


def content(store, seq=None):
    return sorted(((r.order_id, r.sport) for r in store.read("assignments", seq).collect()), key=str)


def written(store, seq):
    return [e for e in store.entries("assignments", seq) if e.path and e.seq == seq]


def test_put_replaces_keys_and_touches_their_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"), partitions=8)
    base = [(f"o{i}", "old") for i in range(40)] + [("o1", "more"), (None, "nobody")]
    store.append("assignments", rows_of(spark, base))
    before = store.entries("assignments")
    assert len(written(store, 1)) == len({e.part for e in before})
    gone = spark.createDataFrame([("o1",), ("o2",), ("o99",)], "order_id string")
    assert store.put("assignments", rows_of(spark, [("o1", "new"), ("o77", "first")]), gone)
    expected = [(o, v) for o, v in base if o not in ("o1", "o2")] + [("o1", "new"), ("o77", "first")]
    assert content(store) == sorted(expected, key=str)
    files = written(store, 2)
    assert len(files) == len({e.part for e in files}) <= 4
    # All files of the snapshot before are taken over as they are.
    assert {e.path for e in before} <= {e.path for e in store.entries("assignments")}
    store.append("assignments", rows_of(spark, [("o1", "later")]))
    assert content(store) == sorted(expected + [("o1", "later")], key=str) and len(written(store, 3)) == 1
    store.put("assignments", rows_of(spark, [(None, "somebody")]))
    assert (None, "somebody") in content(store) and (None, "nobody") not in content(store)
    store.put("assignments", rows_of(spark, []))
    store.overwrite("assignments", store.read("assignments").filter("order_id = 'o1'"))
    assert content(store) == [("o1", "later"), ("o1", "new")]


def test_replayed_batches_change_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    one = rows_of(spark, [("a", "x")])
    assert store.append("assignments", one, ("q", 0)) and store.append("assignments", one, ("other", 0))
    seq = store.snapshots("assignments")
    assert not store.append("assignments", one, ("q", 0)) and not store.put("assignments", one, batch=("other", 0))
    assert store.snapshots("assignments") == seq and len(content(store)) == 2
    assert store.put("assignments", rows_of(spark, [("a", "y")]), batch=("q", 1)) and content(store) == [("a", "y")]
    assert sum(e.path is None for e in store.entries("assignments")) == 2


def test_puts_are_compacted_and_snapshots_expire(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"), partitions=2, keep=2, compact_puts=3)
    for i in range(7):
        store.put("assignments", rows_of(spark, [("a", f"v{i}"), ("b", f"w{i}")]))
        assert content(store) == [("a", f"v{i}"), ("b", f"w{i}")]
        assert len(store.snapshots("assignments")) <= 2
    per_part = {}
    for e in store.entries("assignments"):
        per_part[e.part] = per_part.get(e.part, 0) + 1
    assert max(per_part.values()) <= 3
    kept = {e.path.rsplit("/", 3)[1] for s in store.snapshots("assignments") for e in store.entries("assignments", s)}
    assert len(list((tmp_path / "db/assignments/data").iterdir())) <= len(kept) + 1
    for s in store.snapshots("assignments"):
        assert store.read("assignments", s).count() == 2


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    store, other = (Store(spark, str(tmp_path / "db")) for _ in range(2))
    store.append("assignments", rows_of(spark, [("a", "x")]))
    write = store._write

    def late(*args):
        other.append("assignments", rows_of(spark, [("b", "y")]))
        return write(*args)

    monkeypatch.setattr(store, "_write", late)
    with pytest.raises(Exception, match="(?i)exists"):
        store.append("assignments", rows_of(spark, [("c", "z")]))
    assert content(other) == [("a", "x"), ("b", "y")]


def test_a_round_writes_what_it_changes(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    sources = spark.createDataFrame([(f"s{i}", "green", True) for i in range(200)], "code string, risk_class string, active boolean")
    store.overwrite("registry_sources", sources.selectExpr("code", "risk_class", "active", """named_struct('list_urls', array('https://h/x'),
      'link_regex', 'href="([^"]+)"', 'title_regex', '', 'order_date_regex', '', 'order_number_regex', '', 'pagination', '', 'max_pages', 1, 'js_var', '') AS detect""",
                                                               "'pdf_portal' AS source_type"))
    page = spark.createDataFrame([("s7", 0, 1, "https://h/x", '<a href="https://h/a.pdf">x</a>', None)], "source_code string, list_no int, page_no int, url string, html string, etag string")
    page.write.parquet(str(tmp_path / "in"))
    at = lambda: F.lit("2024-01-01").cast("timestamp")
    for _ in range(2):
        J.watch_pages(spark, str(tmp_path / "in"), store, str(tmp_path / "ckpt"), at, once=True).awaitTermination()
    assert store.read("orders").count() == 1 and store.read("registry_sources").count() == 200
    assert store.read("registry_sources").filter("last_page_hash IS NOT NULL").select("code").collect()[0].code == "s7"
    newest = [e for e in store.entries("registry_sources") if e.path and e.puts]
    assert len(newest) == 1 and spark.read.parquet(newest[0].path).count() == 1
    assert store_module.KEYS["registry_sources"] == "code"
