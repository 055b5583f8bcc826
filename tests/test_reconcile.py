from meterline.operators import reconcile as R

COLS = "app_id long, monitoring_id string, app_name string, cmdb_id string, cmdb_name string"


def test_lowest_app_wins_and_claimed_records_conflict(spark):
    app = spark.createDataFrame([
        (1, "m1", "Pay 7", None, None), (2, "m2", " pay 7", None, None), (9, None, None, "c9", "PAY 7 "), (10, None, None, "c10", "pay 7"),
        (3, "m3", "Hr 1", None, None), (11, None, None, "c11", "hr 1"), (4, "m4", "Other", "c11", "hr"),
        (5, "m5", "alone", None, None), (6, "m6", None, None, None), (7, "m7", "Pay 8", None, None), (12, None, None, "c12", "pay 9"),
        (13, None, None, "c13", None), (14, "m14", "", None, None)], COLS)
    log, id_map = R.reconcile(app)
    got = sorted((r.match_key_a, r.match_key_b, r.match_status, r.resolved_app_id, r.notes) for r in log.collect())
    assert got == [(" pay 7", "PAY 7 ", "conflict", None, "CMDB record already matched to Pay 7"),
                   ("Hr 1", "hr 1", "conflict", None, "CMDB record already matched to Other"),
                   ("Pay 7", "PAY 7 ", "auto_matched", 1, None)]
    assert [tuple(r) for r in id_map.collect()] == [(9, 1)]


def test_names_that_differ_in_a_digit_never_match(spark):
    app = spark.createDataFrame([(i, f"m{i}", f"Supplier#00000000{i}", None, None) for i in range(1, 6)]
                                + [(i, None, None, f"c{i}", f"Supplier#00000000{i}") for i in range(6, 10)], COLS)
    log, id_map = R.reconcile(app)
    assert log.count() == id_map.count() == 0


def test_repointed_facts_keep_their_sum(spark):
    fact = spark.createDataFrame([(1, 2.0), (9, 3.0), (5, 1.0)], "app_id long, usd_cost double")
    id_map = spark.createDataFrame([(9, 1)], "old_app_id long, new_app_id long")
    assert sorted(tuple(r) for r in R.repoint_fact(fact, id_map).collect()) == [(1, 2.0), (1, 3.0), (5, 1.0)]
