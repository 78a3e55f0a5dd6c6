"""Pass 2, pass 3 and the overlap grouping of interlinking, on raw names with known answers."""

from tidemark.operators import interlink


def test_fuzzy_keys(spark):
    rows = [
        ("Dolo 650mg Tablet", None, None, "a"), ("Dolo 650 Tablets", "", "650 mg", "b"), ("Crocin 500mg", None, None, "c"), ("Crocin 500mg Tab", None, None, "c"),
        ("Zed 5mg", None, None, "d"), ("Zed 10mg", None, None, "e"), ("Brand One 5mg", "alpha", None, "f"), ("Other Two 5mg", "alpha", None, "g"), (None, None, None, "h"), ("Dolo 650mg", None, None, None),
    ]
    got = interlink.fuzzy_key_groups(spark.createDataFrame(rows, "name string, normalized_name string, dosage string, canonical_key string")).collect()
    assert [tuple(r) for r in got] == [("dolo|650mg", 3)]


def test_integer_doses(spark):
    rows = [
        ("Abc 2.6mg", None, None, "Salt A"), ("Abc 2.5mg", None, None, "salt-a"), ("Abc 2.7mg", None, None, "other"), ("Def 5mg", None, None, None), ("Def 5.5mg", None, None, " "),
        ("Ghi 7mg", None, None, "x"), ("Ghi 7 mg tab", None, None, "x"), ("Brand One 5.1mg", "alpha", None, "x"), ("Other Two 5.2mg", "alpha", None, "x"), ("Nodose", None, None, "x"),
    ]
    got = interlink.integer_dose_groups(spark.createDataFrame(rows, "name string, normalized_name string, dosage string, salt string")).collect()
    assert {tuple(r) for r in got} == {("abc|2|salta", 2), ("def|5|NOSALT", 2)}


def test_overlap_groups(spark):
    rows = [
        (1, "a b c d e", "5 mg", None), (2, "a b c d x", "5.0mg", None), (3, "a b c y x", "5mg", None), (4, "a b c y x tablet", "5mg", ""), (5, "a b c d e", "10mg", None), (6, "Cipla Dolo 5mg", "5mg", "Cipla Ltd"),
        (7, "dolo tablets", "5MG", None), (8, "", "5mg", None), (9, "a b c d", None, None), (10, "a b c d", "5mg", None),
    ]
    got = interlink.overlap_groups(spark.createDataFrame(rows, "id long, name string, dosage string, manufacturer string")).collect()
    assert {tuple(r) for r in got} == {("5mg", 1, 1), ("5mg", 1, 2), ("5mg", 1, 10), ("5mg", 3, 3), ("5mg", 3, 4), ("5mg", 6, 6), ("5mg", 6, 7)}
