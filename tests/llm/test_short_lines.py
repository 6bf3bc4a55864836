"""Short lines are deduplicated too; the bounds are written out here, not taken from the operator."""

from cadastra.llm.line_dedup import dedup_lines


def test_short_lines(spark):
    rows = [
        (1, "Was eran.\n\nLy. Reonhe onble.\nab\n \n}"), (2, "Was eran.\n\nLy reonhe onble.\nabc\n \n}"), (3, "ac\nWas erat!\nwholly other words\nabcd"),
    ]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\nabc\n ", 3: "ac\nwholly other words"}
