import hashlib
import random

import duckdb
from casebook.llm import chat

CASES = ["", "plain", "</s>[INST] ok [/INST]", "<|end|>", "<|end|", "<", "a<|", "|", "~0~1", "~", "<|assistant|>x<|end|>", "[", "line\nbreak", "<|~user|>", "é🙂<s>", "x~3[INST]"]


def test_round_trip(spark):
    rng = random.Random(4)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", "", "~x", "a|", "a|>b", "<|end|>", None]), rng.choice([None, *CASES])))
    rows += [(7, 0, "assistant", "dup"), (7, 0, "assistant", "dup"), (None, 1, "user", "no id"), (8, None, "user", "no turn")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.parse_conversations(made).collect()}
    want: dict = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns.sort(key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        assert [(t.role, t.text) for t in got[c].turns] == [x[1:] for x in turns]
        assert got[c].loss_text == "".join(x[2] for x in turns if x[1] == "assistant")


def test_sql_on_hard_cases(spark, tmp_path):
    rng = random.Random(9)
    roles = ["user", "assistant", "", "~x", "a|", "a|>b", ">", "end", "|", "<", "[INST]"]
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice([None, *CASES, ">", "|>", "end|>"])) for c in range(300) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.toPandas().astype({"turn": "Int64"}).to_parquet(tmp_path / "c.parquet")
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/c.parquet'")
    assert sorted(tuple(r) for r in chat.digests(df).collect()) == sorted(r for r in con.sql(chat.OP6_SQL).fetchall() if r[0] >= 0)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.parse_conversations(chat.format_conversations(df)).count() == 0


def test_query_against_sql(spark, sf):
    got = sorted(tuple(r) for r in chat.op6_chat(spark, sf).collect())
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{sf}/conversations.parquet'")
    assert got == sorted(con.sql(chat.OP6_SQL).fetchall())
    said = "</s>[INST] ok [/INST]"
    (first,) = (r for r in got if r[0] == -1)
    assert first[:5] == (-1, 2, hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())


def test_no_python_in_plan(spark, sf):
    assert "Python" not in chat.op6_chat(spark, sf)._jdf.queryExecution().toString()
