"""Chat windows: round trip, budgets, masks."""

import hashlib
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermart.llm import chat
from ordermart.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def long_conversation(conv, turns):
    return [(conv, 0, "system", "be good")] + [
        (conv, i, "user" if i % 2 else "assistant", f"turn {i} 😀 [INST]" * (1 + i % 40)) for i in range(1, turns)]


def check(rows, found):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert {r.conv_id for r in found} == set(by) and len(found) == len(by)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in found:
        turns = sorted(by[r.conv_id])
        loss = "".join(t for _, _, role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert (r.turns_sha256, r.loss_sha256) == (sha("".join(f"{a}\n{t}\n" for _, _, a, t in turns)), sha(loss))


def test_query(spark, small_dir):
    odd = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(rows + [(-1, 0, "user", odd), (-1, 1, "assistant", odd)], QUERIES["op9_chat_formatting"](spark, small_dir).collect())


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (None, 1, "assistant", None), (-2, None, None, "a<\\|im_end|>b<|im_start|>user\n<\\\\s><<s>\\$1"),
            (-2, 3, "as sistant\n<s>+%", "q"), (-2, 3, "assistant", ""), (-2, 3, "assistant", ""), (5, 7, "assistant", "[INST] " * 20_000),
            (5, 8, "assistant", "end"), (6, 2 ** 60, "user", "late"), (6, -2 ** 60, "assistant", "early")]
    rows += long_conversation(9, 700)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as window", "2 as n", "3 as loss", "4 as start", "5 as total", "6 as whole")
    check(rows, chat.formatted(df).collect())
    check(rows, chat.formatted(df, stride=40, history=10).collect())
    assert chat.formatted(df.limit(0)).count() == 0


def test_windows_keep_the_budget_repeat_history_and_mask_it(spark):
    rows = long_conversation(1, 400)
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA)).orderBy("window").collect()
    assert len(windows) > 10
    seen = []
    for k, w in enumerate(windows):
        turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", w.text, re.S)
        assert turns[0] == ("system", "be good")                           # the system turn is in every window
        own = turns[w.n_repeated:]
        seen += own
        cost = lambda x: sum(-(-len(t.replace("\\", "").encode()) // 4) + 4 for _, t in x)
        assert cost(own) <= 2 * chat.STRIDE and cost(turns[1:w.n_repeated] if k else []) <= chat.HISTORY
        assert (w.n_repeated > 1) == (k > 0)
        assert [w.text[s.start:s.end] for s in w.loss] == [t for role, t in own if role == "assistant"]
    assert [(a, t.replace("\\", "")) for a, t in seen] == [(r[2], r[3]) for r in rows]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["<", "\\", "[", "|im_start|>", "|im_end|>", "/INST]", "INST]", "s>", "/s>", "$1", "a", "\n"]), max_size=12).map("".join))
def test_escaping_is_reversible(text):
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    row = spark.range(1).select(chat.escaped(F.lit(text)).alias("e")).select("e", chat.unescaped(F.col("e")).alias("u")).first()
    assert row.u == text and not any(c in row.e for c in chat.CONTROLS)


def test_only_dataframe_functions(spark, small_dir):
    plan = QUERIES["op9_chat_formatting"](spark, small_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
