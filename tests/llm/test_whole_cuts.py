from newsloom.llm import truncated

SCHEMA = "article_seq long, source_name string, title_original string, description string, public_excerpt string"


def test_a_sentence_of_a_longer_copy_is_cut(spark):
    short = "The harbour authority redrafted a timetable."
    rows = [(1, "A", "t", short, None), (2, "B", "t", short + " Stocks kept at Veimbstad amount to 750 points.", None), (3, "C", "t", "Quite another thing ended here.", None), (4, "D", "t", short, short)]
    got = {tuple(x) for x in truncated.p6_found(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "description"), (4, "description"), (4, "public_excerpt")}


def test_a_repeating_excerpt_follows_its_description(spark):
    """Descriptions pile up at one length, excerpts don't: those that repeat a piled one must come out with it."""
    bodies = [(f"{chr(97 + i)}item went on and on to the market place of city " + "x" * 40)[:60] for i in range(8)]
    ends = [" ".join(f"{w}" for w in ("went on and on to the market place of city", "x" * n)) + "." for n in range(1, 40)]
    rows = [(i, "A", "t", b, b if i == 0 else None) for i, b in enumerate(bodies)] + [(100 + i, "A", "t", e, None) for i, e in enumerate(ends)]
    got = {(x.article_seq, x.field_name) for x in truncated.p6_found(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (0, "description") in got and (0, "public_excerpt") in got
