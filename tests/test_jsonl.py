import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.schemas import BRONZE_SCHEMA, PARSE_ERROR, SCHEMA_ERROR, VALID
from strata.sources.jsonl import bronze, quarantine, read_lines

# (line, expected status); blank lines give no row.
CASES = [
    ('{"person":{"gender":"m","country":"x"},"status":{"treatment":"yes"},"lifestyle":{}}', VALID),
    ("{}", VALID),
    ('{"person":null}', VALID),
    ('{"person":{"gender":1.50,"country":true}}', VALID),
    ('{"a":NaN}', VALID),
    ('{"person":{"gender":"a"},"person":{"gender":"b"}}', VALID),
    ('{"person":{"gender":"x"}', PARSE_ERROR),
    ('{"a":1} tail', PARSE_ERROR),
    ('{"a":1}}', PARSE_ERROR),
    ('{"a":1}]', PARSE_ERROR),
    ('{"a":1},{"b":2}', PARSE_ERROR),
    ('{"a":1}{"b":2}', PARSE_ERROR),
    ("{'a':1}", PARSE_ERROR),
    ('{"a":1,}', PARSE_ERROR),
    ('{"a":"x\ty"}', PARSE_ERROR),
    ('{a:1}', PARSE_ERROR),
    ('{"a":01}', PARSE_ERROR),
    ("5", SCHEMA_ERROR),
    ('"s"', SCHEMA_ERROR),
    ("[1]", SCHEMA_ERROR),
    ("null", SCHEMA_ERROR),
    ("true", SCHEMA_ERROR),
    ('{"person":"abc"}', SCHEMA_ERROR),
    ('{"person":[1]}', SCHEMA_ERROR),
    ('{"person":{"gender":"x"}, "status": 5}', SCHEMA_ERROR),
    ('[{"person":{}}]', SCHEMA_ERROR),
    ("null]}", PARSE_ERROR),            # would close a {"r":[...]} wrapper early
    ('"a"] }{"b":1}', PARSE_ERROR),
    ("1]]", PARSE_ERROR),
    ('{"a":[1]}', VALID),
    ('{"person":{"gender":"x"},"a":[[1], {"b":[]} ]}', VALID),
]


def _python_status(line):
    """The reference's rule, extended: json.loads fails -> parse_error; JSON that is not an
    object, or a group that is not an object -> schema_error."""
    try:
        r = json.loads(line)
    except json.JSONDecodeError:
        return PARSE_ERROR
    if not isinstance(r, dict):
        return SCHEMA_ERROR
    if any(r.get(g) is not None and not isinstance(r.get(g), dict) for g in ("person", "status", "lifestyle")):
        return SCHEMA_ERROR
    return VALID


def _bronze_of(spark, lines):
    return bronze(spark.createDataFrame([(line,) for line in lines], "value string"))


@pytest.mark.parametrize("line,expected", CASES)
def test_cases_agree_with_python(line, expected):
    assert _python_status(line) == expected


def test_status_per_line(spark):
    out = _bronze_of(spark, [c[0] for c in CASES]).select("_raw_data", "_status").collect()
    assert [r["_status"] for r in out] == [c[1] for c in CASES]
    for r, (line, status) in zip(out, CASES):
        assert (r["_raw_data"] == line) if status != VALID else r["_raw_data"] is None


def test_blank_lines_skipped_and_lines_stripped(spark):
    b = _bronze_of(spark, ["", "   ", "\t　", '  {"person":{"gender":"f"}}\t']).collect()
    assert len(b) == 1 and b[0]["_status"] == VALID and b[0]["person"]["gender"] == "f"


def test_values_to_text_and_schema(spark):
    b = _bronze_of(spark, ['{"person":{"gender":1.50,"country":true,"occupation":{"a":1}}}'])
    assert b.schema.simpleString() == BRONZE_SCHEMA.simpleString()
    p = b.collect()[0]["person"]
    assert (p["gender"], p["country"], p["occupation"]) == ("1.5", "true", '{"a":1}')
    ts = b.collect()[0]["_ingestion_timestamp"]
    assert isinstance(ts, float) and ts > 1.6e9


def test_read_lines_keeps_cr_inside(spark, tmp_path):
    path = tmp_path / "raw.jsonl"
    path.write_bytes(b'{"person":\r{"gender":"m"}}\n\n{"person":{"gender":"f"}}\n')
    lines = read_lines(spark, str(path))
    assert lines.count() == 3
    b = bronze(lines)
    assert sorted(r["_status"] for r in b.collect()) == [VALID, VALID]


def test_quarantine(spark):
    q = quarantine(_bronze_of(spark, ['{"a":', "5", "{}"])).collect()
    assert sorted((r["_status"], r["_raw_data"]) for r in q) == [(PARSE_ERROR, '{"a":'), (SCHEMA_ERROR, "5")]


_TOKENS = ['{', '}', '[', ']', '"a"', '"person"', ':', ',', '1', '01', '-0', '1.', '.5', '1e5', 'true',
           'null', 'NaN', ' ', '\t', '"\\q"', "'s'", '{"gender":"m"}', '+1', '/*c*/', 'nul']


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_TOKENS), min_size=1, max_size=8).map("".join),
                min_size=20, max_size=60))
def test_status_matches_python_on_token_soup(spark, lines):
    lines = [x for x in lines if x.strip()]
    got = _bronze_of(spark, lines).select("_status").collect()
    assert [r[0] for r in got] == [_python_status(x.strip()) for x in lines]
