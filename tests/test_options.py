import pytest

from propgraph import GraphOptions
from propgraph import options as o


def resolve(spark, **given):
    return GraphOptions.resolve(spark, {k.replace("__", "."): v for k, v in given.items()})


@pytest.mark.parametrize("given", [{}, {"element.type": ""}])
def test_element_type_is_required(spark, given):
    with pytest.raises(ValueError, match="^Parameter 'element.type' is required$"):
        GraphOptions.resolve(spark, given)


def test_defaults(spark):
    assert GraphOptions.resolve(spark, {"element.type": "EDGE"}) == GraphOptions(
        "EDGE", (), "ALL", "thing", "hasEntity", "shard"
    )


def test_optional_values_are_trimmed_and_empty_ones_missing(spark):
    found = GraphOptions.resolve(spark, {
        "element.type": "VERTEX", "conceptType": "  Person ", "labelType": "", "authorizations": " a,b ",
    })
    assert found.concept_type == "Person"
    assert found.label_type == "hasEntity"
    assert found.authorizations == ("a,b",), "one token, not split"


def test_session_settings_are_defaults_and_options_win(spark):
    spark.conf.set("spark.propgraph.conceptType", "FromSession")
    spark.conf.set("spark.propgraph.element.type", "VERTEX")
    try:
        assert GraphOptions.resolve(spark, {}).concept_type == "FromSession"
        assert GraphOptions.resolve(spark, {"conceptType": "Mine"}).concept_type == "Mine"
    finally:
        spark.conf.unset("spark.propgraph.conceptType")
        spark.conf.unset("spark.propgraph.element.type")


@pytest.mark.parametrize("name, value", [
    ("element.type", "NODE"), ("reader.fetchHints", "SOME"), ("partitioning.strategy", "round"),
])
def test_unknown_choices_are_errors(spark, name, value):
    with pytest.raises(ValueError, match=f"'{name}'"):
        GraphOptions.resolve(spark, {"element.type": "VERTEX", name: value})


def test_unknown_option_names_are_errors(spark):
    with pytest.raises(ValueError, match="Unknown options: batch"):
        GraphOptions.resolve(spark, {"element.type": "VERTEX", "batch": "1"})
