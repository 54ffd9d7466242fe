from seedwright.operators.selection import parse_progress
from seedwright.sources.catalog import load_catalog, template_check
from seedwright.sources.tables import parse_spec, resolve_specs


def test_parse_spec():
    s = parse_spec("name:field: a , b:12")
    assert (s.name, s.text_field, s.splits, s.min_chars) == ("name", "field", ["a", "b"], 12)
    assert parse_spec("name").splits == ["train"]
    assert parse_spec("n:f:train:x").min_chars is None
    r = resolve_specs(["a", "b::train", "c"], ["t1", "t2"])
    assert [x.text_field for x in r] == ["t1", "t2", "text"]
    assert resolve_specs(["a", "b"], ["only"])[1].text_field == "only"


def test_catalog_and_template_check(spark):
    cat = load_catalog(spark)
    assert cat.n_agents == 357 and len(cat.tasks) == 17
    flagged = {r["name"] for r in template_check(cat).filter("flagged").collect()}
    assert flagged == {"Style Transfer Generator", "Tone Adjustment Generator",
                       "Translation Generator", "Reading Level Adjustment Generator"}
    assert cat.one_shots.count() == 17


def test_progress_lines(spark):
    lines = spark.createDataFrame([("3",), (" 4 ",), ("x",), ("",), ("3",)], "value string")
    assert sorted(r[0] for r in parse_progress(lines).collect()) == [3, 4]
