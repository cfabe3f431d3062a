"""Landing to gold on stored tables, in batches and as a stream."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime, timedelta

import pytest

from stratum.operators import quality
from stratum.plans.layers import CLEAN, LITERAL, Layers
from stratum.sources import landing
from stratum.sources.gold_table import GoldTable
from stratum.sources.tables import SILVER, STAGING
from stratum.streaming import ingest

DAY = datetime(2024, 5, 6)

DAYS = [
    {
        "Customers_20240506_1.csv": "index,customer_id,name,location_city,location_country\n0,1,ann,rome,it\n1,2,bob,oslo,no\n",
        "Flavours_20240506_1.csv": "flavour_id,name,description\n1,mint,fresh\n2,lime,sour\n",
        "Ingredients_20240506_1.csv": "ingredient_id,name,chemical_formula,molecular_weight,cost_per_gram,provider_id\n"
        "1,menthol,C,1.5,2.0,1\n2,acid,D,2.5,4.0,1\n",
        "Recipes_20240506_1.csv": "recipe_id,flavour_id,ingredient_id,quantity_grams,heat_process\n1,1,1,3,cold\n1,1,2,1,cold\n2,2,2,1,hot\n",
        "Stocks_20240506_1.csv": "stock_id,flavour_id,quantity_liters,location\n1,1,10,A\n1,2,5,\n",
        "SalesTransactions_20240506_1.csv": "transaction_id,customer_id,flavour_id,quantity_liters,transaction_date,country,town,postal_code,amount_dollar\n"
        "1,1,1,2,2024-05-01,it,rome,1,20\n2,2,2,1,2024-05-02,no,oslo,2,3\n1,1,1,2,2024-05-01,it,rome,1,21\n",
    },
    {
        "Customers_20240507_1.csv": "customer_id,index,location_country,name,location_city\n1,0,it,ann,pisa\n3,1,se,cat,lund\n",
        "Ingredients_20240507_1.csv": "ingredient_id,name,chemical_formula,molecular_weight,cost_per_gram,provider_id\n1,menthol,C,1.5,6.0,1\n",
        "Stocks_20240507_1.csv": "stock_id,flavour_id,quantity_liters,location\n1,1,10,A\n1,2,7,B\n",
        "SalesTransactions_20240507_1.csv": "transaction_id,customer_id,flavour_id,quantity_liters,transaction_date,country,town,postal_code,amount_dollar\n"
        "2,2,2,1,2024-05-02,no,oslo,2,5\n3,3,1,1,2024-05-03,se,lund,3,9\n",
    },
]


def land(root, day):
    folder = root / f"2024050{6 + day}"
    folder.mkdir(parents=True)
    for name, text in DAYS[day].items():
        (folder / name).write_text(text)


def run_days(spark, tmp_path, policy, only=None):
    layers = Layers(spark, str(tmp_path / "store"), policy)
    for day in range(2):
        land(tmp_path / f"landing{day}", day)
        deliveries = landing.manifest(landing.list_files(spark, str(tmp_path / f"landing{day}")))
        if only:
            deliveries = deliveries.where(deliveries.table_name.isin(*only))
        for _, rejects in layers.ingest(deliveries, DAY + timedelta(days=day), f"day {day}"):
            assert rejects.count() == 0
        landed = {n.split("_")[0].lower() for n in DAYS[day]}
        layers.merge_all(f"day {day}", sorted(landed & set(only or landed)))
    return layers


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    return run_days(spark, tmp_path_factory.mktemp("clean"), CLEAN)


def content(df):
    keep = [c for c in df.columns if c not in ("row_id",)]
    return Counter(map(tuple, df.select(*keep).collect()))


def test_clean_end_state(batch):
    cities = {(r.customer_id, r.city, r.active) for r in batch.silver("customers").collect()}
    assert cities == {(1, "rome", False), (1, "pisa", True), (2, "oslo", True), (3, "lund", True)}
    assert batch.staging("customers").where("merge_status = 0").count() == 0
    assert {(r.transaction_id, r.amount_dollar) for r in batch.silver("salestransactions").collect()} in (
        {(1, 20.0), (2, 5.0), (3, 9.0)}, {(1, 21.0), (2, 5.0), (3, 9.0)}
    )


def test_gold_from_stored_layers(batch):
    rows = {r.transaction_id: (r.customer_name, r.cost_per_liter, r.total_cost) for r in batch.create_gold_view().collect()}
    assert rows == {1: ("ann", 5.5, 11.0), 2: ("bob", 4.0, 4.0), 3: ("cat", 5.5, 5.5)}


def test_checks_pass(batch):
    for entity in ("customers", "ingredients", "recipes", "stocks"):
        quality.enforce(batch.check(entity))
    quality.enforce(quality.gold_checks(batch.gold()))


def test_same_label_changes_nothing(spark, batch):
    store = batch.stores["customers"]
    before = content(store.read(SILVER)), store.commits().count()
    batch.merge("customers", "day 1")
    assert (content(store.read(SILVER)), store.commits().count()) == before


def test_run_without_commit_is_never_read(spark, tmp_path):
    """A merge that wrote its files but no commit row, then another load, then the merge again."""
    layers, plain = (Layers(spark, str(tmp_path / n)) for n in ("failed", "plain"))
    for day in range(2):
        land(tmp_path / f"landing{day}", day)
    found = [landing.manifest(landing.list_files(spark, str(tmp_path / f"landing{d}"))).where("table_name = 'customers'") for d in range(2)]
    for x in (layers, plain):
        x.ingest(found[0], DAY, "a")
        x.merge("customers", "a")
    store = layers.stores["customers"]
    settled = store.current(SILVER).selectExpr("*", "'settled' AS kind")
    settled.write.partitionBy("kind").parquet(f"{store.folder}/silver/run={store._last().run + 1}-lost")
    for x in (layers, plain):
        x.ingest(found[1], DAY + timedelta(days=1), "b")
        x.merge("customers", "b")
    assert content(store.read(SILVER)) == content(plain.silver("customers"))
    before = content(store.read(SILVER)), content(store.read(STAGING))
    assert any("lost" in f for f in store.vacuum())
    assert (content(store.read(SILVER)), content(store.read(STAGING))) == before
    assert store.vacuum() == []


def test_deliveries_are_loaded_once_whatever_the_label(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "store"))
    land(tmp_path / "landing", 0)
    found = lambda: landing.manifest(landing.list_files(spark, str(tmp_path / "landing"))).where("table_name = 'customers'")
    layers.ingest(found(), DAY, "a")
    layers.merge("customers", "a")
    folder = tmp_path / "landing" / "20240506"
    (folder / "Customers_20240506_2.csv").write_text("index,customer_id,name,location_city,location_country\n4,9,eve,bern,ch\n")
    refused = dict(layers.ingest(found(), DAY + timedelta(hours=1), "a"))["customers"].collect()
    assert [(os.path.basename(r.delivery), r.reason) for r in refused] == [("Customers_20240506_1.csv", "already loaded")]
    layers.merge("customers", "a")
    assert {r.customer_id for r in layers.silver("customers").collect()} == {1, 2, 9}
    layers.ingest(found(), DAY + timedelta(hours=2), "b")
    assert layers.staging("customers").count() == 3
    assert len({r.row_id for r in layers.staging("customers").collect()}) == 3


def test_rejected_delivery_may_come_again_and_quotes_are_read(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "store"))
    folder = tmp_path / "landing"
    folder.mkdir()
    bad = {
        "Flavours_20240506_1.csv": "flavour_id,name,description\n1,mint\n",
        "Flavours_20240506_2.csv": "flavour_id,name,description\n2,lime,sour,EXTRA\n",
        "Flavours_20240506_3.csv": 'flavour_id,name,description\n3,"two\nlines",x\n',
        "Flavours_20240506_4.csv": 'flavour_id,name,description\n4,"say ""hi"", you",x\n',
    }
    for name, text in bad.items():
        (folder / name).write_text(text)
    found = lambda: landing.manifest(landing.list_files(spark, str(folder)))
    refused = dict(layers.ingest(found(), DAY, "a"))["flavours"].collect()
    assert sorted(os.path.basename(r.delivery)[-5] for r in refused if r.reason == "bad value") == ["1", "2"]
    assert sorted(r.name for r in layers.staging("flavours").collect()) == ['say "hi", you', "two\nlines"]
    (folder / "Flavours_20240506_1.csv").write_text("flavour_id,name,description\n1,mint,fresh\n")
    layers.ingest(found(), DAY, "a")
    assert {r.flavour_id for r in layers.staging("flavours").collect()} == {1, 3, 4}


def test_clean_merge_keeps_what_it_refuses(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "store"))
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "Flavours_20240506_1.csv").write_text("flavour_id,name,description\n1,mint,fresh\n,nokey,x\n")
    layers.ingest(landing.manifest(landing.list_files(spark, str(folder))), DAY, "a")
    assert [(r.name, r.reason) for r in layers.merge("flavours", "a").collect()] == [("nokey", "null key")]
    (folder / "Flavours_20240506_2.csv").write_text("flavour_id,name,description\n1,late,x\n2,lime,sour\n")
    layers.ingest(landing.manifest(landing.list_files(spark, str(folder))), DAY - timedelta(days=1), "b")
    assert [(r.name, r.reason) for r in layers.merge("flavours", "b").collect()] == [("late", "late")]
    assert layers.refused("flavours").count() == 2 and layers.silver("flavours").count() == 2
    assert layers.unprocessed("flavours").count() == 0


def test_gold_sink_is_ordered_by_month(spark, batch, tmp_path):
    batch.write_gold(str(tmp_path / "gold"))
    assert sorted(f for f in os.listdir(tmp_path / "gold") if "=" in f) == ["month=2024-05"]
    assert content(spark.read.parquet(str(tmp_path / "gold")).drop("month")) == content(batch.gold())
    quality.enforce(batch.check_gold())


def test_refreshed_gold_follows_upserts(spark, tmp_path):
    layers, path = Layers(spark, str(tmp_path / "store")), str(tmp_path / "gold")
    written = []
    for day in range(2):
        land(tmp_path / f"landing{day}", day)
        layers.ingest(landing.manifest(landing.list_files(spark, str(tmp_path / f"landing{day}"))), DAY + timedelta(days=day), f"day {day}")
        layers.merge_all(f"day {day}")
        written += [layers.refresh_gold(path), layers.refresh_gold(path)]
        assert content(GoldTable(spark, path).read()) == content(layers.gold())
    assert written == [["2024-05"], [], ["2024-05"], []]


def test_settled_rows_are_not_written_again(batch):
    store = batch.stores["customers"]
    written = os.listdir(f"{store.folder}/silver")
    assert len([w for w in written if w.startswith("run=")]) == 2
    assert {(r.customer_id, r.city) for r in store.settled(SILVER).collect()} == {(1, "rome")}
    assert store.current(STAGING).count() == 0 and store.settled(STAGING).count() == 4


def test_literal_policy_keeps_pending_rows(spark, tmp_path):
    layers = run_days(spark, tmp_path, LITERAL, only=["customers", "stocks"])
    # New rows stay pending; when customer 1 changes they come back in as an extra active version.
    active = layers.silver("customers").where("active").collect()
    assert Counter((r.customer_id, r.city) for r in active) == {(1, "rome"): 1, (1, "pisa"): 1, (2, "oslo"): 1, (3, "lund"): 1}
    waiting = {(r.customer_id, r.location_city) for r in layers.staging("customers").where("merge_status = 0").collect()}
    assert waiting == {(2, "oslo"), (3, "lund")}
    stocks = {(r.flavour_id, r.quantity_liters, r.active) for r in layers.silver("stocks").collect()}
    assert stocks == {(1, 10.0, True), (2, 5.0, False), (2, 7.0, True)}


def test_stream_equals_batch_and_reads_files_once(spark, batch, tmp_path):
    layers = Layers(spark, str(tmp_path / "store"), CLEAN)
    source, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")

    def run():
        load_time = lambda batch_id: DAY + timedelta(days=batch_id)
        ingest.start(
            spark, str(source), layers, checkpoint, load_time, archive=str(tmp_path / "ingested")
        ).awaitTermination()

    land(source, 0)
    run()
    land(source, 1)
    run()
    commits = layers.stores["customers"].commits().count()
    run()
    assert layers.stores["customers"].commits().count() == commits == 4
    for entity in ("customers", "flavours", "ingredients", "recipes", "stocks"):
        assert content(layers.silver(entity)) == content(batch.silver(entity)), entity
        assert content(layers.staging(entity)) == content(batch.staging(entity)), entity
    keys = lambda x: {(r.transaction_id, r.customer_id) for r in x.silver("salestransactions").collect()}
    assert keys(layers) == keys(batch)
    archived = [f for _, _, fs in os.walk(tmp_path / "ingested") for f in fs]
    assert "Customers_20240506_1.csv" in archived


def silver_files(store):
    top = f"{store.folder}/silver"
    return {os.path.relpath(os.path.join(d, f), top) for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet")}


def sales_file(folder, batch, rows):
    folder.mkdir(exist_ok=True)
    head = "transaction_id,customer_id,flavour_id,quantity_liters,transaction_date,country,town,postal_code,amount_dollar\n"
    lines = [f"{i},1,1,1,2024-05-01,it,rome,1,{amount}\n" for i, amount in rows]
    (folder / f"SalesTransactions_20240506_{batch}.csv").write_text(head + "".join(lines))


def test_upsert_leaves_files_of_untouched_buckets(spark, tmp_path):
    layers, folder = Layers(spark, str(tmp_path / "store"), buckets=8), tmp_path / "landing"
    store = layers.stores["salestransactions"]
    found = lambda: landing.manifest(landing.list_files(spark, str(folder)))
    sales_file(folder, 1, [(i, i) for i in range(200)])
    layers.ingest(found(), DAY, "a")
    layers.merge("salestransactions", "a")
    first = silver_files(store)
    assert len({f.split("bucket=")[1].split("/")[0] for f in first}) == 8
    sales_file(folder, 2, [(7, 1000), (500, 1)])
    layers.ingest(found(), DAY + timedelta(days=1), "b")
    layers.merge("salestransactions", "b")
    rows = {r.transaction_id: r.amount_dollar for r in layers.silver("salestransactions").collect()}
    assert rows == {i: float(i) for i in range(200)} | {7: 1000.0, 500: 1.0}
    touched = store.buckets_of(layers.silver("salestransactions").where("transaction_id IN (7, 500)"))
    added = silver_files(store) - first
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in added} == set(touched) and len(touched) <= 2
    used = {f.split("silver/")[1] for f in layers.silver("salestransactions").inputFiles()}
    assert {f for f in used if int(f.split("bucket=")[1].split("/")[0]) not in touched} < first
    # A later store takes the number of buckets from the table, whatever it is told.
    again = Layers(spark, str(tmp_path / "store"), buckets=3)
    sales_file(folder, 3, [(8, 5)])
    again.ingest(found(), DAY + timedelta(days=2), "c")
    again.merge("salestransactions", "c")
    assert again.stores["salestransactions"].buckets == 8
    before = content(again.silver("salestransactions"))
    assert len(before) == 201 and again.silver("salestransactions").where("transaction_id = 8 AND amount_dollar = 5").count() == 1
    assert any("bucket=" in f for f in store.vacuum())
    assert content(again.silver("salestransactions")) == before and store.vacuum() == []
    assert silver_files(store) == {f.split("silver/")[1] for f in again.silver("salestransactions").inputFiles()}
    again.merge("salestransactions", "nothing pending")
    assert content(again.silver("salestransactions")) == before


def test_snapshot_lists_only_runs_that_cover_the_time(spark, tmp_path):
    layers, folder = Layers(spark, str(tmp_path / "store")), tmp_path / "landing"
    folder.mkdir()
    for day in range(4):
        name = f"Flavours_2024050{6 + day}_1.csv"
        (folder / name).write_text(f"flavour_id,name,description\n1,mint,v{day}\n{day + 2},new,x\n")
        found = landing.manifest(landing.list_files(spark, str(folder))).where(f"file_name = '{name}'")
        layers.ingest(found, DAY + timedelta(days=day), f"{day}")
        layers.merge("flavours", f"{day}")
    assert len(layers.stores["flavours"]._closed(SILVER)) == 3
    for day in range(4):
        rows = layers.snapshot("flavours", DAY + timedelta(days=day, hours=1))
        assert {(r.flavour_id, r.description) for r in rows.collect()} == {(1, f"v{day}"), *[(d + 2, "x") for d in range(day + 1)]}
        settled = {f.split("silver/")[1].split("/")[0] for f in rows.inputFiles() if "kind=settled" in f}
        assert len(settled) == (1 if day < 3 else 0)
    assert layers.snapshot("flavours", DAY - timedelta(days=1)).count() == 0


def test_loaded_files_move_to_the_archive_even_after_a_crash(spark, tmp_path, monkeypatch):
    layers, source, kept = Layers(spark, str(tmp_path / "store")), tmp_path / "landing", tmp_path / "archive"
    land(source, 0)
    (source / "20240506" / "Flavours_20240506_9.csv").write_text("flavour_id,name,description\nsix,bad,row\n")
    found = lambda: landing.manifest(landing.list_files(spark, str(source)))
    files = lambda top: sorted(f for _, _, fs in os.walk(top) for f in fs if f.endswith(".csv"))

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:  # killed between the first commit and its moves
        patched.setattr(landing, "move", killed)
        with pytest.raises(KeyboardInterrupt):
            layers.ingest(found(), DAY, "a", archive=(str(source), str(kept)))
    assert len(files(source)) == 7 and files(kept) == []
    layers.ingest(found(), DAY, "a", archive=(str(source), str(kept)))
    assert files(source) == ["Flavours_20240506_9.csv"] and files(kept) == sorted(DAYS[0])
    assert {e: layers.staging(e).count() for e in ("customers", "flavours", "salestransactions")} == {
        "customers": 2, "flavours": 2, "salestransactions": 3
    }
    assert layers.ingest(found(), DAY, "b", archive=(str(source), str(kept)))[0][0] == "flavours"
    assert layers.staging("flavours").count() == 2


def test_processed_staging_of_other_loads_is_not_read(spark, tmp_path):
    layers = run_days(spark, tmp_path, LITERAL, only=["recipes"])
    store, folder = layers.stores["recipes"], tmp_path / "more"
    folder.mkdir()
    head = "recipe_id,flavour_id,ingredient_id,quantity_grams,heat_process\n"
    (folder / "Recipes_20240509_1.csv").write_text(head + "1,1,1,3,warm\n9,9,9,9,x\n")
    layers.ingest(landing.manifest(landing.list_files(spark, str(folder))), DAY + timedelta(days=3), "c")
    rows = Layers._of_pending_loads(store)
    assert "inserted_at" in rows._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    layers.merge("recipes", "c")
    active = {(r.recipe_id, r.ingredient_id, r.heat_process) for r in layers.silver("recipes").where("active").collect()}
    assert active == {(1, 1, "warm"), (1, 2, "cold"), (2, 2, "hot"), (9, 9, "x")}


def test_row_ids_have_no_gaps_over_loads(batch):
    for entity in ("customers", "salestransactions", "stocks"):
        ids = sorted(r.row_id for r in batch.staging(entity).select("row_id").collect())
        assert ids == list(range(1, len(ids) + 1))
