import json

from llm_helpers import SMALL, as_text, oracle_rows  # noqa: F401

from finmart.llm import chat_tools as C

COLUMNS = ("conv_id bigint, turn bigint, role string, text string, kind string, call_id string, "
           "name string, arguments string, after string")


def call(conv, turn, call_id, arguments="{}", name="t", after=None):
    return (conv, turn, "assistant", None, "call", call_id, name, arguments, after)


def result(conv, turn, call_id, text="done"):
    return (conv, turn, "user", text, "result", call_id, None, None, None)


def linked(llm, rows, schemas):
    got = C.link_tool_calls(llm.createDataFrame(rows, COLUMNS), schemas).collect()
    return {(r.conv_id, r.turn): r for r in got}, got


def test_links_levels_and_errors(llm):
    rows = [call(1, 0, "a"), result(1, 1, "a"), call(1, 2, "b", after="a"), call(1, 3, "c", after="b"),
            result(1, 9, "c"), result(1, 10, "zz"), call(1, 11, "x", after="y"), call(1, 12, "y", after="x"),
            call(1, 13, "q", after="x"), call(1, 14, "d", after="nope"), call(1, 15, "e"), call(1, 16, "e"),
            call(1, 17, None), call(2, 0, "b", after="a"), call(None, 0, "a"), result(None, 1, "a"),
            (1, 20, "system", "hello", "message", None, None, None, None),
            (None, None, None, None, "message", None, None, None, None)]
    got, order = linked(llm, rows, {"t": {"properties": {}}})
    level = {k: r.level for k, r in got.items()}
    assert [level[1, t] for t in (0, 1, 2, 3, 9)] == [0, 1, 2, 4, 5]
    assert level[None, 0] == 0 and level[None, 1] == 1 and level[2, 0] == 0
    error = {k: r.error for k, r in got.items()}
    assert error[1, 0] == "" and error[1, 10] == "no such call" and error[1, 14] == "unknown citation"
    assert error[1, 11] == error[1, 12] == error[1, 13] == "cycle" and level[1, 11] is None
    assert error[1, 15] == error[1, 16] == "identifier used twice" and error[1, 17] == "no identifier"
    assert error[2, 0] == "unknown citation"  # the call it names is in another conversation
    assert got[1, 0].linked and not got[1, 2].linked and got[1, 9].linked and not got[1, 10].linked
    assert len(order) == len(rows)
    mine = [r.level for r in order if r.conv_id == 1]
    known = [x for x in mine if x is not None]
    assert known == sorted(known) and mine[:len(known)] == known
    assert C.link_tool_calls(llm.createDataFrame([], COLUMNS), C.TOOLS).count() == 0


def test_long_chains(llm):
    n = 700
    rows = [call(1, i, f"c{i}", after=f"c{i - 1}" if i else None) for i in range(n)]
    got, _ = linked(llm, rows, {"t": {}})
    assert all(got[1, i].level == 2 * i for i in range(n))


def test_schemas(llm):
    cases = [('{"limit": 5, "query": "x"}', ""), ('{"query":"x","limit":11}', "limit too large"),
             ('{"limit":0,"query":"x"}', "limit too small"), ('{"query": 5}', "wrong type of query"),
             ('{"limit":2.5,"query":"x"}', "wrong type of limit"), ('{"limit":1}', "missing query"),
             ('{"query":"x","more":1}', "unexpected argument"), ("[1]", "arguments are no object; missing query"),
             ('{"query":"x"', "malformed arguments"), ('{"query":"x","query":"y"}', "malformed arguments"),
             (None, "malformed arguments"), ("", "malformed arguments")]
    rows = [call(1, i, f"c{i}", a, "search") for i, (a, _) in enumerate(cases)]
    rows += [call(1, 90, "t", '{"text":"a","to":"xx"}', "translate"), call(1, 91, "n", "{}", "nothing"),
             call(1, 92, "m", "{}", None)]
    got, _ = linked(llm, rows, C.TOOLS)
    for i, (_, want) in enumerate(cases):
        assert got[1, i].error == want, cases[i]
    assert got[1, 90].error == "to not allowed"
    assert got[1, 91].error == got[1, 92].error == "unknown tool"


def test_nested_schemas(llm):
    import pytest
    schema = {"type": "object", "required": ["id", "f"], "properties": {
        "f": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {
            "a": {"type": "string", "minLength": 2, "maxLength": 3, "pattern": "^x"},
            "b": {"anyOf": [{"type": "integer", "exclusiveMinimum": 3}, {"const": None}]}}},
        "tags": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "string", "enum": ["p", "q"]}},
        "o": {"oneOf": [{"minimum": 1}, {"maximum": 5}]}}, "additionalProperties": {"type": "integer"}}
    cases = [('"id":1,"f":{"a":"xy","b":4},"tags":["p","q"],"o":9', ""), ('"id":1,"f":{"a":"xy","b":null}', ""),
             ('"f":{"a":"xy"}', "missing id"), ('"id":1,"f":{}', "missing f.a"), ('"id":1,"f":5', "wrong type of f"),
             ('"id":1,"f":{"a":"x"}', "f.a too short"), ('"id":1,"f":{"a":"xxxx"}', "f.a too long"),
             ('"id":1,"f":{"a":"yy"}', "f.a doesn't match its pattern"),
             ('"id":1,"f":{"a":"xy","b":3}', "f.b fits none of its schemas"),
             ('"id":1,"f":{"a":"xy","c":3}', "unexpected argument in f"),
             ('"id":1,"f":{"a":"xy"},"tags":[]', "tags has too few items"),
             ('"id":1,"f":{"a":"xy"},"tags":["p","z"]', "tags[] not allowed"),
             ('"id":1,"f":{"a":"xy"},"tags":["p","p","q"]', "tags has too many items"),
             ('"id":1,"f":{"a":"xy"},"o":3', "o doesn't fit one of its schemas"),
             ('"id":1,"f":{"a":"xy"},"more":"x"', "wrong type of *")]
    rows = [call(1, i, f"c{i}", "{" + a + "}") for i, (a, _) in enumerate(cases)]
    got, _ = linked(llm, rows, {"t": schema})
    assert [got[1, i].error for i in range(len(cases))] == [want for _, want in cases]
    with pytest.raises(ValueError):
        linked(llm, rows, {"t": {"properties": {"a": {"$ref": "#/x"}}}})


def test_canonical_json(llm):
    rows = [call(1, 0, "a", '{ "z": {"b": 1.50, "a": [true, null]},\n "é": "x\\u00e9\\n/" }'),
            result(1, 1, "a", 'say "hi"\n'), result(1, 2, "a", None)]
    got, _ = linked(llm, rows, {"t": {}})
    assert got[1, 0].canonical == ('{"arguments":{"z":{"a":[true,null],"b":1.5},"é":"xé\\n/"},'
                                   '"id":"a","name":"t","type":"call"}')
    assert json.loads(got[1, 1].canonical) == {"content": 'say "hi"\n', "id": "a", "type": "result"}
    assert got[1, 2].canonical == '{"id":"a","type":"result"}'


def test_given_conversations_match_sql(llm):
    got = C.link_tool_calls(C.with_tool_messages(llm.read.parquet(f"{SMALL}/conversations.parquet")), C.TOOLS)
    assert as_text(got.toPandas()) == as_text(oracle_rows(C.ORACLE, SMALL, "conversations"))


def test_text_and_malformed_arguments_stay_whole(llm):
    text = "a text of more than forty characters " * 30_000
    rows = [call(1, 0, "a", '{"query":"x"}', "search"), call(1, 1, "b", '{"query":"x"', "search")]
    rows = [r[:3] + (text,) + r[4:] for r in rows] + [call(1, 2, "c", None, "search")]
    got = C.link_tool_calls(llm.createDataFrame(rows, COLUMNS), C.TOOLS).collect()
    a, b, c = (json.loads(r.canonical) for r in sorted(got, key=lambda r: r.turn))
    assert a["content"] == b["content"] == text and a["arguments"] == {"query": "x"}
    assert b["arguments"] == '{"query":"x"' and c == {"id": "c", "name": "search", "type": "call"}
    given = llm.read.parquet(f"{SMALL}/conversations.parquet")
    got = C.link_tool_calls(C.with_tool_messages(given), C.TOOLS).collect()
    texts = {(r.conv_id, r.turn): r.text for r in given.collect()}
    for r in got:
        said = json.loads(r.canonical)
        assert said["content"] == texts[r.conv_id, r.turn]
        main = [v for v in said["arguments"].values() if v == texts[r.conv_id, r.turn]] if (
            r.kind == "call" and isinstance(said["arguments"], dict)) else None
        assert main is None or main or len(texts[r.conv_id, r.turn]) % 11 == 0


ARRAYS = COLUMNS.replace("after string", "after array<string>")


def longest(cites):
    """Longest path of citations to each call, by plain recursion; None in or after a cycle."""
    depth, on_path = {}, set()

    def of(node):
        if node in on_path:
            return None
        if node not in depth:
            on_path.add(node)
            above = [of(p) for p in cites[node] if p in cites]
            on_path.discard(node)
            depth[node] = None if None in above else max((d + 1 for d in above), default=0)
        return depth[node]

    return {n: of(n) for n in cites}


def test_calls_that_cite_several(llm):
    import random
    rng = random.Random(8)
    cites = {f"n{i}": [f"n{j}" for j in rng.sample(range(i), min(i, rng.choice([0, 1, 1, 1, 2, 3])))] for i in range(150)}
    cites |= {f"s{i}": [f"s{i - 1}"] if i else [] for i in range(40)}           # a long stretch
    cites |= {"two": ["s39", "n10"], "far": ["two", "s3", "s3", None], "end": ["far"]}
    cites |= {"x": ["y", "n1"], "y": ["z"], "z": ["x"], "after": ["z", "n2"], "later": ["after"]}  # cycle
    cites |= {"gone": ["nowhere", "s5"]}
    rows = [call(1, i, c, after=list(a)) for i, (c, a) in enumerate(cites.items())]
    rng.shuffle(rows)
    got = C.link_tool_calls(llm.createDataFrame(rows, ARRAYS), {"t": {}}).collect()
    want = longest({c: [p for p in a if p] for c, a in cites.items()})
    for c in ("x", "y", "z", "after", "later"):
        want[c] = None
    assert {r.call_id: r.level for r in got} == {c: None if d is None else 2 * d for c, d in want.items()}
    error = {r.call_id: r.error for r in got}
    assert error["gone"] == "unknown citation" and error["later"] == error["x"] == "cycle" and error["two"] == ""
    assert want["end"] == 42 and json.loads(next(r.canonical for r in got if r.call_id == "two"))["after"] == ["s39", "n10"]


def test_clashing_columns_repeated_rows_and_text_ids(llm):
    from pyspark.sql import functions as F
    rows = [call(1, 0, "a"), result(1, 1, "a")] * 3 + [call(1, 2, "b", after="a")]
    df = llm.createDataFrame(rows, COLUMNS)
    plain = C.link_tool_calls(df, {"t": {}}).collect()
    assert len(plain) == 7 and sum(r.error == "identifier used twice" for r in plain) == 3
    for name in ("copies", "depth", "results", "unknown", "node", "parents", "_v", "_at", "level", "error", "cites"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted(map(str, C.link_tool_calls(df, {"t": {}}).collect())) == sorted(map(str, plain))
    text_ids = COLUMNS.replace("conv_id bigint", "conv_id string")
    rows = [("a/b", 0, "x", None, "call", "c", "t", "{}", None), ("a", 0, "x", None, "result", "b/c", None, None, None),
            ("", 0, "x", None, "call", "c", "t", "{}", None), (None, 0, "x", None, "result", "c", None, None, None)]
    got = C.link_tool_calls(llm.createDataFrame(rows, text_ids), {"t": {}}).collect()
    assert not any(r.linked for r in got)  # none of them belong together
    given = llm.read.parquet(f"{SMALL}/conversations.parquet").withColumn("_given", F.lit(1)).withColumn("kind", F.lit(2))
    assert C.link_tool_calls(C.with_tool_messages(given), C.TOOLS).count() == given.count()


def test_plan_has_no_python(llm):
    got = C.link_tool_calls(C.with_tool_messages(llm.read.parquet(f"{SMALL}/conversations.parquet")), C.TOOLS)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
