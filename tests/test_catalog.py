import pytest
from pyspark.sql import types as T

from propgraph.operators import catalog as c

PERSON = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("_conceptType", T.StringType()),
    T.StructField("_visibility", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
])


def test_new_properties_get_the_fixed_attributes():
    catalog = c.register_properties(c.Catalog(), PERSON)
    assert [p.name for p in catalog.properties] == ["name", "age"], "reserved columns are no properties"
    name, age = catalog.properties
    assert (name.type, name.display_name, name.concept, name.text_hint) == ("STRING", "name", "thing", "ALL")
    assert (age.type, age.text_hint) == ("INTEGER", "EXACT_MATCH")
    assert not age.system_property
    assert age.user_visible and age.searchable and age.updatable and age.addable


def test_first_registration_wins():
    catalog = c.register_properties(c.Catalog(), PERSON)
    again = c.register_properties(catalog, T.StructType([T.StructField("age", T.LongType())]))
    assert again is catalog
    assert again.find("age").type == "INTEGER"


def test_durations_are_registered_as_such(spark):
    from propgraph import make_duration
    frame = spark.range(1).select(make_duration(days=1).alias("d"))
    assert c.register_properties(c.Catalog(), frame.schema).find("d").type == "DURATION"


def test_names_that_differ_by_case_only_are_errors():
    catalog = c.register_properties(c.Catalog(), PERSON)
    with pytest.raises(ValueError, match="only by case"):
        c.register_properties(catalog, T.StructType([T.StructField("Name", T.StringType())]))


def test_inferred_schemas():
    catalog = c.register_properties(c.Catalog(), PERSON)
    hidden = c.Property("secret", "STRING", "secret", user_visible=False)
    unknown = c.Property("maybe", "STRING", "maybe", user_visible=None)
    catalog = c.Catalog(catalog.properties + (hidden, unknown), catalog.types)
    vertex = c.infer_schema(catalog, "VERTEX")
    assert vertex.fieldNames() == ["_conceptType", "_id", "name", "age"]
    assert c.infer_schema(catalog, "EDGE").fieldNames() == ["_did", "_sid", "_edgeLabel", "_id", "name", "age"]
    assert [f.nullable for f in vertex] == [False, False, True, True]


def test_concepts_and_relationships():
    catalog = c.register_types(c.Catalog(), c.CONCEPT, ["Person", "thing", "Person"])
    catalog = c.register_types(catalog, c.RELATIONSHIP, ["knows"])
    person, knows = catalog.types[1:]
    assert (person.display_name, person.parent, person.user_visible) == ("Person", "thing", True)
    assert (knows.kind, knows.source, knows.target) == ("relationship", "thing", "thing")
    assert c.register_types(catalog, c.CONCEPT, ["Person"]) is catalog
    # A concept is no relationship, even under the same name.
    assert c.register_types(catalog, c.RELATIONSHIP, ["Person"]).has_type(c.RELATIONSHIP, "Person")


def test_dropping():
    catalog = c.register_types(c.register_properties(c.Catalog(), PERSON), c.CONCEPT, ["Person"])
    assert not c.drop_type(catalog, c.CONCEPT, "Person").has_type(c.CONCEPT, "Person")
    with pytest.raises(ValueError, match="root concept"):
        c.drop_type(catalog, c.CONCEPT, "thing")
    with pytest.raises(ValueError, match="No concept"):
        c.drop_type(catalog, c.CONCEPT, "Cat")
    with pytest.raises(ValueError, match="No property"):
        c.drop_property(catalog, "weight")
    # A name used again never meets the old values.
    for turn in (1, 2):
        catalog = c.register_properties(c.drop_property(catalog, "age"), PERSON)
        assert catalog.find("age").column == f"age@{turn}"


def test_conflicting_casts():
    catalog = c.register_properties(c.Catalog(), T.StructType([T.StructField("n", T.LongType())]))

    def casts(dtype, **options):
        return c.conflicting_casts(catalog, T.StructType([T.StructField("n", dtype)]), **options)

    assert casts(T.LongType()) == {}
    assert casts(T.IntegerType()) == {"n": T.LongType()}
    with pytest.raises(ValueError, match="'n' is LONG in the catalog, not STRING"):
        casts(T.StringType())
    assert casts(T.StringType(), allow_lossy=True) == {"n": T.LongType()}


def test_listings(spark):
    catalog = c.register_types(c.register_properties(c.Catalog(), PERSON), c.RELATIONSHIP, ["knows"])
    assert c.list_properties(spark, catalog).collect() == [("name", "STRING"), ("age", "INTEGER")]
    assert c.list_concepts(spark, catalog).collect() == [("thing", None)]
    assert c.list_labels(spark, catalog).collect() == [("knows", "thing", "thing")]
    assert c.properties_frame(spark, catalog).count() == 2
    assert c.types_frame(spark, c.Catalog(types=()), c.CONCEPT).count() == 0
