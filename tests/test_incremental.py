"""Account health kept up to date from changed rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from acceptance.fixtures import Fixture, raw_rows
from acceptance.registry import earlier_rows, later_rows
from revloom.plans import incremental
from revloom.plans.incremental import AccountHealth
from revloom.plans.model import RevenueModel, Staged

SF = "/root/testdata/sf0.001"
BUCKETS = 8


def staged(fixture, rows):
    return Staged.from_raw(lambda entity: raw_rows(entity, rows(fixture, entity)))


def scores(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A state after both loads, and health after each."""
    fixture, path = Fixture(spark, SF), tmp_path_factory.mktemp("health")
    state, seen = AccountHealth(spark, str(path), BUCKETS), []
    for rows in (earlier_rows, later_rows):
        state.refresh(staged(fixture, rows))
        seen.append(scores(state.read(fixture.as_of)))
    return fixture, path, state, seen


def test_each_load_equals_a_rebuild(loaded):
    fixture, _, state, (first, second) = loaded
    assert first == scores(RevenueModel(staged(fixture, earlier_rows), fixture.as_of).fct_account_health)
    assert second == scores(fixture.model().fct_account_health)
    assert first != second and len(first) != len(second)
    later = F.lit("2010-01-01 00:00:00").cast("timestamp")  # the score follows the time it is read at
    assert scores(state.read(later)) == scores(RevenueModel(fixture.staged(), later).fct_account_health)


def test_the_same_rows_again_change_nothing(loaded):
    fixture, _, state, (_, second) = loaded
    state.refresh(staged(fixture, later_rows))
    assert scores(state.read(fixture.as_of)) == second


def test_untouched_buckets_are_not_read(loaded, spark, tmp_path):
    fixture, path, state, _ = loaded
    deal = fixture.entity("deals").where("stage_id = 'closedwon' and amount_usd >= 0").orderBy("deal_id").limit(1)
    (row,) = deal.collect()
    tables = state.tables
    owner = state.tables["deals"].read().where(F.col("deal_id") == row["deal_id"]).select("deal_id", "company_id")
    (ours,) = tables["accounts"].touched(owner)
    before = tables["accounts"].read_buckets([ours]).collect()
    deals = tables["deals"].touched(owner)
    sold = tables["subscriptions_by_deal"].touched(owner)
    used = {"deals": deals, "subscriptions_by_deal": sold}
    used |= dict.fromkeys(("deals_by_company", "links_by_company", "reach_by_company", "accounts", "companies"), [ours])
    spoiled = 0
    for name in tables:
        for file in (path / name).rglob("*.parquet"):
            if not any(f"_bucket={b}/" in str(file) for b in used.get(name, [])):
                file.write_bytes(b"")  # whoever opens it fails
                spoiled += 1
    assert spoiled > 50

    def lost(fixture, entity):
        rows = fixture.entity(entity)
        return deal.withColumn("stage_id", F.lit("closedlost")) if entity == "deals" else rows.limit(0)

    state.refresh(staged(fixture, lost))
    after = tables["accounts"].read_buckets([ours]).collect()
    changed = [(a, b) for a, b in zip(sorted(before), sorted(after), strict=True) if a != b]
    assert len(changed) == 1
    ((was, now),) = changed
    assert (now["deal_count_won"], now["deal_count_lost"]) == (was["deal_count_won"] - 1, was["deal_count_lost"] + 1)
    assert now["arr_usd"] <= was["arr_usd"]


def test_a_load_is_read_once(spark, tmp_path):
    """Blobs of a load used to be taken apart again for every use of its rows."""
    fixture = Fixture(spark, SF)

    def raw(entity):
        raw_rows(entity, fixture.entity(entity)).write.parquet(str(tmp_path / "raw" / entity))
        return spark.read.parquet(str(tmp_path / "raw" / entity))

    changed, copies = Staged.from_raw(raw), []
    copied = incremental.stored_copy

    def copy(df, name):
        copies.append((name, df))
        return copied(df, name)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(incremental, "stored_copy", copy)
        AccountHealth(spark, str(tmp_path / "h"), 4).refresh(changed)
    for entity in ("companies", "deals", "contacts"):
        uses = [name for name, df in copies if f"/raw/{entity}" in " ".join(df.inputFiles())]
        links = ["new-links"] if entity == "contacts" else []
        assert sorted(uses) == sorted([f"staged-{entity}", *links])


def test_only_rows_past_the_mark_are_taken(spark, tmp_path):
    fixture = Fixture(spark, SF)
    state = AccountHealth(spark, str(tmp_path / "h"), 4)
    taken = []
    refresh = state.refresh
    state.refresh = lambda changed: (taken.append(changed.deals.count()), refresh(changed))
    early = lambda e: raw_rows(e, fixture.entity(e)).where("_loaded_at < timestamp'1996-01-01'")
    state.refresh_from_raw(early)
    state.refresh_from_raw(lambda e: raw_rows(e, fixture.entity(e)))
    state.refresh_from_raw(lambda e: raw_rows(e, fixture.entity(e)))
    total = fixture.entity("deals").count()
    assert 0 < taken[0] < total and taken == [taken[0], total - taken[0], 0]
    assert scores(state.read(fixture.as_of)) == scores(fixture.model().fct_account_health)
    with pytest.raises(ValueError, match="keyed"):
        refresh(fixture.staged(keyed=False))
