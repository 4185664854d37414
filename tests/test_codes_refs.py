from workpulse.operators import codes, refs


def test_bridge_trims_and_keeps_positions(spark):
    df = spark.createDataFrame([("t1", "e1", "A | B"), ("t2", "e1", "C|"), ("t3", "e2", None)],
                               "timesheet_id string, client_employee_id string, pay_code string")
    b = sorted(map(tuple, codes.explode_codes(df).collect()))
    assert b == [("t1", "e1", 0, "A"), ("t1", "e1", 1, "B"), ("t2", "e1", 0, "C"), ("t2", "e1", 1, "")]
    counts = {r.timesheet_id: r.pay_code_count for r in codes.with_packed_count(df).collect()}
    assert counts["t1"] == 2 and counts["t2"] == 2


def test_flags_including_loa_false_positive(spark):
    df = spark.createDataFrame([("TM-12 OT 50HP",), ("Float pool",), ("zzOTHER",), ("LOA - Un Paid TM",)],
                               "pay_code string")
    got = {r.pay_code: (r.has_overtime_pay_code, r.has_leave_pay_code)
           for r in codes.with_code_flags(df).collect()}
    assert got == {"TM-12 OT 50HP": (True, False), "Float pool": (False, True),
                   "zzOTHER": (False, False), "LOA - Un Paid TM": (False, True)}
    strict = {r.pay_code: r.has_leave_pay_code for r in codes.with_code_flags(
        df, flags={"leave": codes.LEAVE_PATTERN_STRICT}).collect()}
    assert strict["Float pool"] is False and strict["LOA - Un Paid TM"] is True


def test_rollup_matches_array_flags(spark):
    df = spark.createDataFrame([("t1", "e", "Hourly|TM-12 OT 50HP"), ("t2", "e", "Vacation TM")],
                               "timesheet_id string, client_employee_id string, pay_code string")
    bridge = codes.explode_codes(df)
    rolled = {r.timesheet_id: (r.has_overtime_pay_code, r.has_leave_pay_code)
              for r in codes.rollup_code_flags(bridge, codes.code_dimension(bridge)).collect()}
    direct = {r.timesheet_id: (r.has_overtime_pay_code, r.has_leave_pay_code)
              for r in codes.with_code_flags(df).collect()}
    assert rolled == direct


def test_reference_flags(spark):
    emp = spark.createDataFrame([("1", None), ("2", "1"), ("3", "9")],
                                "client_employee_id string, manager_employee_id string")
    got = {r.client_employee_id: r.manager_exists for r in refs.with_reference_flag(
        emp, "manager_employee_id", emp, "client_employee_id", "manager_exists",
        null_when_missing=True).collect()}
    assert got == {"1": None, "2": True, "3": False}
    total = {r.client_employee_id: r.m for r in refs.with_reference_flag(
        emp, "manager_employee_id", emp, "client_employee_id", "m").collect()}
    assert total == {"1": False, "2": True, "3": False}
    assert [r.manager_employee_id for r in refs.orphans(
        emp, "manager_employee_id", emp, "client_employee_id").collect()] == ["9"]


def test_packed_rules_equal_per_code_rules(spark):
    import itertools
    vals = ["OT", " OT ", "A|OT", "A | OT", "OT|B", "XOT", "OTX", "TM-12 OT 50HP", "a-ot", "b ot|c",
            "LOA", "Float", "x|", "|", "", "OT -", "-OT", "A|-OT", "A| OT|B", "JURY|DUTY", "Sick"]
    rows = [(v,) for v in vals] + [(f"{a}|{b}",) for a, b in itertools.product(vals, repeat=2)]
    df = spark.createDataFrame(rows + [(None,)], "pay_code string")
    fast = codes.with_code_flags(df).collect()
    per_code = codes.with_code_flags(df, flags=codes.DEFAULT_FLAGS).collect()
    assert [tuple(r) for r in fast] == [tuple(r) for r in per_code]
