from minutebook.operators import assemble


def test_roster_contains_vs_range(spark):
    meetings = spark.createDataFrame([("m72", "1972"), ("m70", "1970"), ("m80", "1980")], "meeting string, year string")
    roster = spark.createDataFrame([("ann", "1970-1975", 1), ("bob", "1975-1980", 2), ("cy", None, 3)],
                                   "name string, year_range string, row_no int")
    contains = {(r.meeting, r.name) for r in assemble.roster_for(meetings, roster).collect()}
    assert contains == {("m72", None), ("m70", "ann"), ("m80", "bob")}
    rng = {(r.meeting, r.name) for r in assemble.roster_for(meetings, roster, mode="range").collect()}
    assert rng == {("m72", "ann"), ("m70", "ann"), ("m80", "bob")}


def test_transcript_header_and_part_order(spark):
    parts = spark.createDataFrame([
        ("boe_meeting_1972-01-05_x", "boe_meeting_1972-01-05_x_part_010", "ten"),
        ("boe_meeting_1972-01-05_x", "boe_meeting_1972-01-05_x_PART_002", "two"),
        ("boe_meeting_1972-01-05_x", "boe_meeting_1972-01-05_x_part_003", None),
        ("a_b", "a_b_part_001", "solo")], "meeting string, part_name string, text string")
    roster = spark.createDataFrame([("zed", "1972-1976", 2), ("amy", "1968-1972", 1), (None, "1972", 0)],
                                   "name string, year_range string, row_no int")
    got = {r.meeting: r.transcript for r in assemble.assemble_transcript(parts, roster).collect()}
    assert got["boe_meeting_1972-01-05_x"] == "Board Members: amy, zed\ntwo\n\nten"
    assert got["a_b"] == "solo"                        # not four tokens: no header
