import hashlib
import re
import unicodedata

import duckdb
from pyspark.sql import functions as F

from tests.llm.fixtures import ROWS, documents
from waymesh.llm import chat, quality

TURNS = [
    (1, 0, "system", "a"), (1, 1, "user", "b"), (1, 2, "user", "c"), (1, 3, "assistant", None), (1, 4, "assistant", "x<|end|>&lt;|y"),
    (2, 5, "assistant", "z&amp;<|also|>"), (2, 5, "assistant", "z"), (2, 5, "assistant", "z"), (2, None, "user", ""), (3, 0, None, "q"),
    (4, 1, "us<|er\n|>", "<"), (4, 0, "user", "<|user|>\U0001f600"), (None, 0, "assistant", "n"), (5, 0, "user", "word " * 50_000),
    (6, 0, "end", "hello"), (6, 1, "user", "hi"), (6, 2, "also", "x"), (6, 3, "turn:user", "|end|>"), (6, 4, "assistant", "a<"), (6, 5, "assistant", "<"), (6, 6, "assistant|>", "b"), (6, 7, "<|end|>", "c"),
]


def brute_chat(rows):
    said = "</s>[INST] ok [/INST]"
    by = {}
    for c, n, role, text in [*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)]:
        by.setdefault(c, []).append(((n is not None, n or 0), role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_is_read_back(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("blocks", F.lit(1))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.op8_chat_format(frame).collect()}
    assert got == brute_chat(TURNS)


def test_loss_spans_cut_the_learned_texts(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    cut = []
    for r in chat.format_conversations(frame).collect():
        cut += [(r["conv_id"], r["formatted"][a:b].replace("&lt;|", "<|").replace("&amp;", "&")) for a, b in r["loss_spans"]]
    want = [(c, x or "") for c, _, role, x in TURNS if role == "assistant"]
    assert sorted(cut, key=str) == sorted(want, key=str)


def test_a_conversation_of_many_turns(spark):
    rows = [(1, k, ("user", "assistant")[k // 3 % 2], f"t{k}") for k in range(2000)]
    got = chat.op8_chat_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("conv_id = 1").first()
    assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"]) == brute_chat(rows)[1]


def test_chat_sql_agrees(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", TURNS)
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = sorted((tuple(r) for r in chat.op8_chat_format(frame).collect()), key=str)
    assert got == sorted(con.execute(chat.OP8_SQL).fetchall(), key=str)


def brute_quality(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = {}
    for k in range(len(words) - 2):
        windows.setdefault(tuple(words[k : k + 3]), []).append(k)
    at = {k + j for ks in windows.values() if len(ks) > 1 for k in ks for j in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(at), n < 50 or 100 * len(at) > 50 * n


def test_quality_counts_match_brute_force(spark):
    rows = [*ROWS, (90, "a b c d a b c x a b c\n" * 3 + "\n\n q", None, None), (91, "x\n\nx\n x\nx\r", None, None)]
    got = quality.op7_quality_rules(documents(spark, rows)).collect()
    want = sorted([(r[0] if r[0] is not None else -1, *brute_quality(r[1])) for r in rows])
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def brute_kept(text):
    text = text or ""
    n, chars, symbols, dup, _, failed = brute_quality(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    letters, upper = (sum(unicodedata.category(c).startswith(k) for c in text) for k in ("L", "Lu"))
    return not (failed or chars < 2 * n or chars > 15 * n or 10 * symbols > n or 100 * dup > 30 * lines or 100 * letters < 60 * chars or 100 * upper > 40 * letters or n > 100_000)


def quality_rows(spark):
    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [*ROWS, *((r["doc_id"] + 1000, r["text"], "en", "s") for r in plain)]
    rows += [(5000, " ".join(f"W{k}X" for k in range(99)), "en", "s"), (5001, " ".join("#" if k % 7 == 0 else f"word{k * k}" for k in range(99)), "en", "s"), (5002, "\n".join(["one line here"] * 2 + [f"other {k * k} lines {k}" for k in range(60)]), "en", "s")]
    return rows


def test_verdicts_match_plain_python(spark):
    rows = quality_rows(spark)
    want = sorted((str(r[0]), brute_kept(r[1])) for r in rows)
    assert sorted((str(r["doc_id"]), r["kept"]) for r in quality.op7_quality_rules(documents(spark, rows)).collect()) == want
    assert {k for _, k in want} == {True, False}
    docs = documents(spark, rows)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(d for d, k in want if k)


def test_order_of_rules_does_not_change_the_verdict(spark):
    base, c, rules = quality.with_base(documents(spark)), quality.counted(), quality.standard_rules()
    order = quality.ordered(quality.sampled(documents(spark)), rules, quality.counts_of(F.col("text")))
    verdicts = base.select(*[quality.cascade(x, c).isNull().alias(f"k{i}") for i, x in enumerate((rules, rules[::-1], order))]).collect()
    assert all(len(set(r)) == 1 for r in verdicts)
    assert {r.name for r in order} == {r.name for r in rules}


def test_cheap_and_selective_rules_come_first(spark):
    docs = spark.createDataFrame([(k, "word " * 3000) for k in range(60)], "doc_id long, text string")
    cheap, dear = quality.Rule("cheap", lambda c: c.text.isNotNull()), quality.Rule("dear", lambda c: c.n_repeat_words > 0)
    never = quality.Rule("never", lambda c: c.n_repeat_words < 0)
    assert [r.name for r in quality.ordered(quality.sampled(docs), [never, dear, cheap], quality.counts_of(F.col("text")))][0] == "cheap"
    assert quality.sampled(docs, rows=10).count() <= 10


def test_empty_tables(spark):
    assert quality.op7_quality_rules(documents(spark, [])).count() == 0 and quality.kept_documents(documents(spark, [])).count() == 0
    assert [r["conv_id"] for r in chat.op8_chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect()] == [-7]
