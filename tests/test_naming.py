"""Naming rules: prefixes, audit columns, keys, parents and the checks they lead to."""

from dataclasses import replace

import pytest

from vaultgauge import Vault, validate
from vaultgauge.plans import catalog as catalog_plan
from vaultgauge.plans.catalog import EmptyVaultError
from vaultgauge.plans.passes import make_plan


def vault(spark, tables):
    def no_data(name):
        raise AssertionError("planning opens no table")

    return Vault(spark, list(tables), no_data, tables.__getitem__)


def plan(spark, settings, tables):
    return make_plan(vault(spark, tables), settings)


def kinds(spark, settings, names):
    listing = vault(spark, {n: [] for n in names}).listing()
    return {r.source_name: r.table_type for r in catalog_plan.classified(listing, settings).collect()}


def test_prefixes(spark, settings):
    assert kinds(spark, settings, ["hub_a", "H_a", "Link_a", "l_a", "SAT_a", "s_a", "hx_a", "hubs", "a_hub_", "_h_"]) == {
        "hub_a": "HUB", "H_a": "HUB", "Link_a": "LINK", "l_a": "LINK", "SAT_a": "SAT", "s_a": "SAT",
        "hx_a": "OTHER", "hubs": "OTHER", "a_hub_": "OTHER", "_h_": "OTHER",
    }


def test_synonyms_go_by_priority_not_by_position(spark, settings):
    t = plan(spark, settings, {"sat_a": ["a_hk", "insert_dts", "load_ts", "load_date", "src_system", "rec_src", "hdiff", "hashdiff"]})
    found = t.targets["SAT_A"]
    assert (found.load_dts, found.record_source, found.hash_diff) == ("LOAD_DATE", "REC_SRC", "HASHDIFF")


def test_fuzzy_goes_by_rule_then_by_position(spark, settings):
    t = plan(spark, settings, {"sat_a": ["a_hk", "created_on", "batch_no", "batch_id", "my_src", "the_source", "difference"]})
    found = t.targets["SAT_A"]
    assert (found.load_dts, found.record_source, found.hash_diff) == ("BATCH_NO", "THE_SOURCE", "DIFFERENCE")


def test_loose_fuzzy_rules(spark, settings):
    t = plan(spark, settings, {"sat_a": ["source_hk", "payload_hash"]})
    found = t.targets["SAT_A"]
    assert (found.load_dts, found.record_source, found.hash_diff) == ("PAYLOAD_HASH", "SOURCE_HK", "PAYLOAD_HASH")
    assert found.own_hk == "SOURCE_HK"


def test_nothing_resolved(spark, settings):
    tables = {"hub_a": ["a_hk"], "sat_a": ["id"]}
    assert [s.check_id for s in plan(spark, settings, tables).specs] == ["H1", "H2", "T4", "T4"]
    rows = {
        r.table_name: r
        for r in catalog_plan.diagnostics(catalog_plan.catalog(vault(spark, tables), settings)).collect()
    }
    assert rows["HUB_A"].missing == ["LOAD_DTS", "RECORD_SOURCE", "HASH_DIFF"]
    assert rows["SAT_A"].hk_columns == []


def test_own_key_by_convention_then_first(spark, settings):
    t = plan(spark, settings, {"hub_a": ["x_hk", "a_hk"], "hub_b": ["y_hk", "x_hk"], "l_a_b": ["a_hk", "a_b_hk", "b_hk"]})
    assert {n: x.own_hk for n, x in t.targets.items()} == {"HUB_A": "A_HK", "HUB_B": "Y_HK", "L_A_B": "A_B_HK"}
    assert t.targets["L_A_B"].references == {"A_HK": "HUB_A", "B_HK": None}


def test_links_take_over_a_key(spark, settings):
    tables = {"l_a_x": ["a_hk", "x_hk"], "hub_a": ["a_hk"], "sat_a": ["a_hk"]}
    assert plan(spark, settings, tables).targets["SAT_A"].references == {"A_HK": "L_A_X"}
    strict = replace(settings, strict_parents=True)
    assert plan(spark, strict, tables).targets["SAT_A"].references == {"A_HK": "HUB_A"}


def test_last_owner_in_catalog_order_counts(spark, settings):
    tables = {"hub_a": ["a_hk"], "h_a": ["a_hk"], "sat_a": ["a_hk"]}
    assert plan(spark, settings, tables).targets["SAT_A"].references == {"A_HK": "H_A"}


def test_order_and_number_of_checks(spark, settings):
    audit = ["load_dts", "record_source"]
    p = plan(
        spark,
        settings,
        {
            "hub_a": ["a_hk", *audit],
            "hub_b": ["b_hk", *audit],
            "link_a_b": ["a_b_hk", "a_hk", "b_hk", "c_hk", *audit],
            "sat_a": ["a_hk", "hash_diff", *audit],
        },
    )
    shared = ["T1", "T2", "T3", "T4", "F1", "F2", "F3", "V1", "V2", "V3", "R1", "R2"]
    assert p.slots(p.targets["HUB_A"]) == ["H1", "H2", *shared]
    assert p.slots(p.targets["LINK_A_B"]) == [
        "L1", "L2:A_HK", "L3:A_HK", "L2:B_HK", "L3:B_HK", "L2:C_HK", "L4", *shared,
    ]
    assert p.slots(p.targets["SAT_A"]) == ["S1", "S2", "S3", "S4", "S5", *shared]


def test_titles_carry_names_and_parameters(spark, settings):
    p = plan(
        spark,
        replace(settings, stale_hours=6, spike_multiplier=9),
        {"hub_a": ["a_hk", "loaded_at"], "sat_a": ["a_hk", "row_hash"]},
    )
    names = {s.check_name for s in p.specs}
    assert {
        "NULL hash key (A_HK)",
        "Orphan records — A_HK not in HUB_A",
        "NULL hashdiff (ROW_HASH)",
        "No new records in last 6h (stale pipeline)",
        "Load spike today vs 7-day avg (>9x)",
    } <= names
    assert not any("{" in s.check_name + s.impact + s.query_text for s in p.specs)


def test_no_vault_tables(spark, settings):
    names = [f"t{n}" for n in range(30)]
    with pytest.raises(EmptyVaultError) as e:
        validate(vault(spark, {n: ["x_hk"] for n in names}), settings)
    assert "30 table(s)" in str(e.value) and "t24." in str(e.value) and "t25" not in str(e.value)
    with pytest.raises(EmptyVaultError):
        validate(vault(spark, {}), settings)
