"""Several fields fitted in one job: the codes of one fit after the other."""

from recsmith.operators import encode as enc

ROWS = [(5, "b", 2.5, None), (3, "a", None, 7), (None, "b", -1.0, 7), (9, None, 2.5, 8), (3, "Z", 0.0, 8), (-4, "a", 1e9, 9)]
SCHEMA = "u long, c string, x double, h int"


def _codes(state):
    rows = [(r.value, r.id) for r in state.collect()]
    assert len(rows) == len({i for _, i in rows}) == len({v for v, _ in rows})
    return dict(rows)


def test_codes_of_all_fields_together(spark):
    df = spark.createDataFrame(ROWS * 3, SCHEMA).repartition(4)
    for unk in (False, True):
        got = enc.fit_encodings(df, ["u", "c", "x", "h"], is_unk=unk)
        for f in ("u", "c", "x", "h"):
            assert _codes(got[f]) == _codes(enc.fit_encoding(df, f, is_unk=unk)), f
            assert dict(got[f].dtypes)["value"] == dict(df.dtypes)[f]


def test_states_are_extended(spark):
    old = spark.createDataFrame(ROWS[:2], SCHEMA)
    new = spark.createDataFrame(ROWS, SCHEMA)
    states = enc.fit_encodings(old, ["u", "c"])
    more = enc.fit_encodings(new, ["u", "c", "h"], states)
    for f in ("u", "c"):
        assert _codes(more[f]) == _codes(enc.fit_encoding(new, f, enc.fit_encoding(old, f)))
    assert _codes(more["h"]) == {None: 1, 7: 2, 8: 3, 9: 4}
    assert _codes(enc.fit_encodings(new, ["u", "c", "h"], more)["u"]) == _codes(more["u"])
    assert states.keys() == {"u", "c"}  # the given states are left as they are


def test_one_numbering_for_nine_fields(spark, monkeypatch):
    calls = []
    plain = enc.range_numbered
    monkeypatch.setattr(enc, "range_numbered", lambda *a: (calls.append(1), plain(*a))[1])
    df = spark.range(50).selectExpr(*[f"id % {k + 2} f{k}" for k in range(9)])
    states = enc.fit_encodings(df, [f"f{k}" for k in range(9)])
    assert len(calls) == 1 and [states[f"f{k}"].count() for k in range(9)] == [k + 2 for k in range(9)]
    assert all(_codes(states[f"f{k}"]) == {v: v + 1 for v in range(k + 2)} for k in range(9))
