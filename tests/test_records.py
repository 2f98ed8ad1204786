from tamarack.operators.records import RecordSpec, extract_records, winner_label

PERSON = (
    '<div class="b-fight-details__person"><i class="b-fight-details__person-status {}">\n {} </i>'
    '<div class="t"><h3 class="n"><a href="/x">  {} </a></h3><p>nick</p></div></div>'
)
WON, LOST = "b-fight-details__person-status_style_green", "b-fight-details__person-status_style_gray"
CELLS = "".join(f"<td class='c'><p>\n {i}a </p>\n<p> {i}b &amp; </p></td>" for i in range(1, 10))
TABLE = (
    "<table><thead><tr><th>H</th></tr></thead><tr><td><p><a href='#'>Al &amp; Co</a></p><p><a>Bo</a></p></td>"
    f"{CELLS}</tr><tr><td><p>later</p></td></tr></table>"
)

CASES = {
    "first side": (PERSON.format(WON, "W", "Al") + PERSON.format(LOST, "L", "Bo") + TABLE, "Al"),
    "second side": (PERSON.format(LOST, "L", "Al") + PERSON.format(WON, "W", "Bo") + TABLE, "Bo"),
    "no contest": (PERSON.format(LOST, "NC", "Al") + PERSON.format(LOST, "NC", "Bo") + TABLE, "NC"),
    "no status": (PERSON.format("plain", "?", "Al") + TABLE, "Unknown"),
    "status outside": (f'<i class="{WON}">W</i>' + PERSON.format("plain", "?", "Al") + TABLE, "Unknown"),
    "hidden": (f"<!-- {PERSON.format(WON, 'W', 'No')} --><script><tr></tr></script>" + TABLE, "Unknown"),
}


def read(spark, *pages):
    """Winner and fields of each page, by the library."""
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string")
    return [list(r)[1:] for r in extract_records(df).orderBy("page_id").collect()]


def test_cases(spark):
    for (_, winner), got in zip(CASES.values(), read(spark, *[page for page, _ in CASES.values()])):
        assert got[0] == winner
        assert got[1:5] == ["Al & Co", "Bo", "1a", "1b &"]
        assert got[-2:] == ["9a", "9b &"]


def test_no_table_and_short_cells(spark):
    fields = len(RecordSpec().fields())
    for got in read(spark, None, "", "<p>x</p>", "<tr><td><p>only</p></td></tr>"):
        assert got == ["Unknown"] + [None] * fields
    got = read(spark, "<tr></tr><tr><td><p>A</p><p>B</p></td><td><p>one</p></td></tr>")[0]
    assert got[1:5] == ["A", "B", "one", None]


def test_columns_in_the_plan(spark, capsys):
    df = spark.range(3).selectExpr("id AS page_id", "concat('<p>', id) AS html")
    extract_records(df).explain()
    assert "InPandas" not in capsys.readouterr().out
    extract_records(df).select("page_id", "winner").explain("extended")
    assert "<td" not in capsys.readouterr().out.split("Optimized Logical Plan")[1]


def test_every_page_gives_a_row(spark):
    rows = [(i, page) for i, (page, _) in enumerate(CASES.values())] + [(99, None)]
    got = extract_records(spark.createDataFrame(rows, "page_id bigint, html string")).orderBy("page_id").collect()
    assert [r.winner for r in got] == [w for _, w in CASES.values()] + ["Unknown"]
    assert got[0].fighter_b_ctrl == "9b &" and got[-1].fighter_a is None


def test_labels(spark):
    rows = [("NC", "a", "b"), (" Draw", "a", "b"), ("d", "d", "b"), ("A ", "a", "b"), ("b", "a", " B"), ("x", "a", "b")]
    df = spark.createDataFrame(rows, "winner string, fighter_a string, fighter_b string")
    got = [r.winner_color for r in winner_label(df).collect()]
    assert got == ["nc", "d", "d", "red", "blue", "unknown"]
