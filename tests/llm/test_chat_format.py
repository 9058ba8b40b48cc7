import hashlib

from pyspark.sql import functions as F

from furlong.llm import chat_format as C


def conversations():
    odd = ["", None, "</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<\\s>", "<s>x</s>\n<s>", "a\n\nb\\n", "<<SYS>>hi<</SYS>> [/INST]", "é漢😀 </s>"]
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(odd)]
    rows += [(2, 0, "system", "be kind")] + [(2, i, ["user", "assistant"][i % 2], f"turn {i} " + "word " * (i % 7 * 9)) for i in range(1, 60)]
    rows += [(3, None, None, "x"), (3, 1, "role\nwith <s> break\\", "y"), (3, 1, "role\nwith <s> break\\", "y"), (3, 2, "assistant", "long " * 30_000), (3, 3, "system", "late")]
    return rows + [(None, 0, "assistant", "alone"), (None, 1, "user", "alone too"), (4, 0, "system", "only")]


def expected(rows):
    groups = {}
    for n, (conv, turn, role, text) in enumerate(rows):
        groups.setdefault(("r", n) if conv is None else conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for key, turns in groups.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        out.append((None if isinstance(key, tuple) else key, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def test_reads_back_what_was_said(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("x"))
    for budget in (40, 1024):
        out = C.digest(C.windows(turns, budget)).collect()
        assert sorted([tuple(r)[:5] for r in out], key=str) == expected(rows)


def test_windows_keep_the_system_turn_and_mask_history(spark):
    turns = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    got = C.windows(turns, 160).where("conv_id = 2").orderBy("window").collect()
    assert len(got) > 5
    seen = ""
    for w in got:
        assert w.formatted.startswith("<s>system\nbe kind</s>\n") and w.formatted.count("<s>system") == 1
        assert w.n_tokens <= 160 + 20
        seen += "".join(w.formatted[s.start : s.end] for s in w.loss_spans)
    assert any(w.n_repeated > 1 for w in got) and got[0].n_repeated == 0
    assert seen == "".join(t for c, _, r, t in conversations() if c == 2 and r == "assistant")


def test_only_built_in_functions(spark):
    turns = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    plan = C.digest(C.windows(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert C.digest(C.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
