import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from innsight.llm import chat_format as cf

TRICKY = ["<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<|", "a<b|c", "", "$1 \\1 \\",
          "%0A %25 %", "line\nline\n", "é\U0001f600 漢", "<" * 9 + "|" * 9]


def canonical(spark, records):
    df = spark.createDataFrame(list(enumerate(records)), "id long, record string")
    return {r.id: (r.layout, None if r.turns is None else [tuple(t) for t in r.turns])
            for r in cf.canonical_turns(df).collect()}


def test_layouts_become_canonical_turns(spark):
    want = [("user", "q"), ("assistant", "a")]
    records = [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", want),
        ({"messages": [{"content": "q", "role": "user"}, {"content": None, "role": "assistant"}]}, "messages",
         [("user", "q"), ("assistant", "")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", want),
        ({"turns": [{"turn": 0, "role": "user", "text": "q"}, {"turn": 1, "role": "assistant", "text": "a"}]}, "turns",
         want),
        ({"prompt": "q", "completion": "a"}, "prompt", want),
        ({"completion": "a", "prompt": "q", "system": "s"}, "prompt", [("system", "s"), *want]),
        ({"prompt": "q", "response": "a"}, "response", want),
        ({"instruction": "q", "input": "", "output": "a"}, "instruction", want),
        ({"instruction": "q", "input": "x", "output": "a"}, "instruction", [("user", "q\n\nx"), ("assistant", "a")]),
        ({"question": "q", "answer": "a"}, "question", want),
        ({"messages": []}, "messages", []),
        ({"prompt": 12, "completion": True}, "prompt", [("user", "12"), ("assistant", "true")]),
        ({"prompt": {"text": "q"}, "completion": "a"}, None, None),
        ({"foo": "q"}, None, None),
        ({"id": 7, "prompt": "q", "meta": {"a": 1, "b": "x"}, "completion": "a", "tags": ["x"]}, "prompt", want),
        ({"a b": 1, "messages": [{"role": "user", "content": "q", "name": "n", "weight": 1},
                                 {"role": "assistant", "content": "a"}], "source": "s"}, "messages", want),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": "x"}, "conversations", want),
        ({"turns": [{"role": "gpt", "text": "q"}]}, "turns", [("gpt", "q")]),
        ({"messages": [], "prompt": "q", "completion": "a"}, None, None),
        ([1, 2], None, None),
    ]
    got = canonical(spark, [json.dumps(r) for r, _, _ in records] + ["{no json", None, ""])
    assert [got[i] for i in range(len(records))] == [(layout, turns) for _, layout, turns in records]
    assert all(got[len(records) + i] == (None, None) for i in range(3))


def test_fingerprint_sees_paths_not_values(spark):
    same = ['{"a": 1, "b": [{"c": "x"}]}', '{"b": [{"c": null}, {"c": 2.5}], "a": "text: STRING, ARRAY<"}']
    other = ['{"a": 1, "b": [{"d": "x"}]}', '{"a": 1, "b": {"c": "x"}}', '{"a": 1}', '{"a": [1], "b": [{"c": "x"}]}']
    df = spark.createDataFrame([(x,) for x in same + other], "r string")
    prints = [r[0] for r in df.select(cf.fingerprint(F.parse_json("r"))).collect()]
    assert prints[0] == prints[1] and len(set(prints)) == 1 + len(other)


def brute_escape(text):
    import re
    return re.sub(r"<(\\*)\|", lambda m: "<" + m[1] + "\\|", text)


def test_round_trip_and_mask(spark):
    convs = [[("user", a), ("assistant", b), (c, a + b)] for a in TRICKY for b in TRICKY
             for c in ("system", "ro\nle%0A<|im_end|>", "")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(convs)], f"id long, turns {cf.TURNS}")
    out = cf.with_format(df).select("id", F.col("formatted").alias("f"), cf.read_turns(F.col("formatted")).alias("t"),
                                    cf.read_loss(F.col("formatted"), F.col("loss")).alias("l"))
    for r in out.collect():
        assert [tuple(t) for t in r.t] == convs[r.id]
        assert r.l == [t for role, t in convs[r.id] if role == "assistant"]
        assert r.f.count(cf.START) == r.f.count(cf.END) == 3


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]),
                          st.text(st.sampled_from("<|\\im_endstar>\n $a"), max_size=30)), max_size=6))
def test_round_trip_property(spark, turns):
    df = spark.createDataFrame([(turns,)], f"turns {cf.TURNS}")
    r = cf.with_format(df).select(cf.read_turns(F.col("formatted")).alias("t")).first()
    assert [tuple(t) for t in r.t] == turns


def brute_digest(rows):
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))
    loss = "".join(x for _, r, x in rows if r == "assistant")
    said = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    return (len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(f"<|im_start|>{brute_escape(r)}\n{brute_escape(x)}<|im_end|>\n") for _, r, x in rows))


def test_conversations_with_nulls_ties_and_long_texts(spark):
    convs = {1: [(0, "user", None), (1, "assistant", "a")], 2: [(0, "user", "b"), (0, "user", "b"), (0, "assistant", "z")],
             None: [(None, None, "x"), (3, "assistant", "<|im_end|>")], 4: [(0, "assistant", "é" * 400_000)],
             5: [(i, ("user", "assistant")[i % 2], f"t{i}") for i in range(500)], 6: [(0, "user", "")]}
    df = spark.createDataFrame([(c, *t, "clash") for c, ts in convs.items() for t in ts],
                               "conv_id long, turn long, role string, text string, record string")
    got = {r.conv_id: tuple(r)[1:] for r in cf.digests(cf.format_chats(cf.conversation_records(df))).collect()}
    assert got == {c: brute_digest(ts) for c, ts in convs.items()}
    assert cf.digests(cf.format_chats(cf.conversation_records(df.limit(0)))).collect() == []


def test_query_against_sql(spark):
    from innsight.llm.queries import QUERIES
    from innsight.llm.sql import ORACLE_SQL
    from innsight.oracle.compare import compare, duckdb_connection

    d, name = "/root/testdata/sf0.01", "op3_chat_formatting"
    found = compare(name, QUERIES[name](spark, d), duckdb_connection(d), ORACLE_SQL[name])
    assert found.ok, str(found)


def test_main_path_runs_no_python(spark):
    from innsight.llm.queries import op3_chat_formatting

    plan = op3_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_query_goes_through_the_fingerprint_join_and_no_parser(spark):
    """Field paths of the rows' structs are hashed and joined to the mapping table; no JSON with its limits."""
    import re

    from innsight.llm.queries import op3_chat_formatting

    plan = op3_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan and "json" not in plan.lower() and "variant" not in plan.lower()
    assert re.search(r"xxhash64\(.*OBJECT<.*AS fingerprint", plan)
    assert re.search(r"BroadcastHashJoin \[fingerprint#\d+L\], \[fingerprint#\d+L\]", plan)


def test_roles_are_read_back_as_the_rows_have_them(spark):
    import duckdb

    from innsight.llm.sql import ORACLE_SQL

    rows = [(1, 0, "human", "q"), (1, 1, "gpt", "a"), (1, 2, "assistant", "b"), (2, 0, "Assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:] for r in cf.digests(cf.format_conversations(df)).collect()}
    assert got == {c: brute_digest([r[1:] for r in rows if r[0] == c]) for c in (1, 2)}
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = {r[0]: r[1:] for r in con.execute(ORACLE_SQL["op3_chat_formatting"]).fetchall()}
    assert {c: found[c] for c in (1, 2)} == got


def test_places_of_many_turns(spark):
    turns = [("assistant" if i % 3 else "user", "x" * (i % 7)) for i in range(1100)]
    df = spark.createDataFrame([(turns,), ([],), (None,)], f"turns {cf.TURNS}")
    rows = cf.with_format(df).select("formatted", "loss").collect()
    text, mask = rows[0]
    assert len(mask) == 1100 and tuple(rows[1]) == ("", []) and tuple(rows[2]) == (None, None)
    for (role, said), m in zip(turns, mask):
        assert text[m.turn:].startswith(cf.START) and text[m.start:].startswith(said + cf.END)
        assert m.length == (len(said) if role == "assistant" else None)


def test_time_grows_with_the_turns(spark):
    """Twice the turns of one conversation take about twice the time (a square would be four times)."""
    import time

    def seconds(n):
        turns = spark.range(n).select(
            F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
            F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
            F.concat(F.lit("text of some length, <|im_end|>, number "), F.col("id").cast("string")).alias("text"))
        began = time.perf_counter()
        r = cf.digests(cf.format_conversations(turns)).first()
        assert r.n_turns == n
        return time.perf_counter() - began

    seconds(1000)
    assert min(seconds(100_000), seconds(100_000)) <= 2.5 * max(seconds(50_000), 0.5)


def test_structs_format_as_json_records_do(spark):
    rows = [(1, 2, "gpt", "b<|im_end|>"), (1, None, "human", None), (1, 0, None, "x\n"), (None, 1, "a%\nb", ""), (3, 1, "bot", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(cf.format_conversations(turns)) == key(cf.format_chats(cf.conversation_records(turns)))


def test_long_records_are_read_like_short_ones(spark):
    """The variant parser gives null for a text of over 20 million characters."""
    shapes = [('{"id": 1, "prompt": "', '", "completion": "b"}', "prompt", 2),
              ('{"messages": [{"role": "user", "name": "x", "content": "', '"}]}', "messages", 1),
              ('{"prompt": "', "", None, 0), ('{"other": "', '"}', None, 0)]
    for n, tried in ((20, shapes), (20_100_000, shapes[1:3])):
        for head, tail, layout, turns in tried:
            record = F.concat(F.lit(head), F.repeat(F.lit("a"), n), F.lit(tail))
            r = cf.canonical_turns(spark.range(1).select("id", record.alias("record"))).select(
                "layout", F.size("turns").alias("n"), F.length(F.get("turns", F.lit(0))["text"]).alias("chars")).first()
            assert (r.layout, r.n, r.chars) == ((layout, turns, n) if layout else (None, None, None))
