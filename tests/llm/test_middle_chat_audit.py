"""Fill-in-the-middle, event-sourced chats and the divergence audit against brute force and on awkward rows."""

import collections
import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import op11_fill_in_middle as middle
from tallystar.llm import op12_event_chat as chat
from tallystar.llm import op13_divergence_audit as audit

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
AWKWARD = [None, "", " ", "\n\n", "x", " x", "x ", "É ü 漢字 😀 text\t", "ab " * 40_000, "q" * 30_000, "a <P> b", "b <S>", "<M>", "a < P> b", "same", "same", "\x00\x01 a"]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "en", None, 1.0, 7, [1]) for i, t in enumerate(AWKWARD)] + [(14, "same", None, "s", 1.0, 7, [1]), (None, "no id", "en", "s", 1.0, 7, [1])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, p double, n long, bits array<int>").repartition(3)


# 11. Fill-in-the-middle


def expected_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
    p, m, s = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or three % 100 >= 50:
        return (doc_id, len(units), "plain", None, None, text)
    form = "spm" if four % 100 < 80 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, len(units), form, len(p), len(m), output)


def test_ranks_count_every_class():
    values = np.random.default_rng(3).integers(0, 8, 1000).astype(np.uint8)
    matrix = middle.WaveletMatrix(values)
    places = np.arange(1001)
    for c in range(8):
        assert matrix.rank(c, places).tolist() == [0, *np.cumsum(values == c)]


def test_cuts_of_random_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab1,é漢😀  \n\t", k=rng.randrange(120))) for _ in range(600)]
    rows = middle.cut_block([*range(600)], texts)
    assert list(zip(*rows.values())) == [expected_middle(i, t) for i, t in enumerate(texts)]
    assert set(rows["form"]) == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [1, 50, middle.BLOCK])
def test_cuts_of_awkward_rows_and_round_trip(awkward, block):
    cut = middle.fill_in_middle(awkward, block).withColumn("again", middle.restored(F.col("output"), F.col("form"))).collect()
    texts = collections.Counter((r["doc_id"], r["text"] or "") for r in awkward.collect())
    assert collections.Counter((r["doc_id"], r["again"]) for r in cut) == texts
    wanted = [expected_middle(i, t) for i, t in texts.elements()]
    assert sorted(map(str, (tuple(r)[:6] for r in cut))) == sorted(map(str, wanted))


def test_no_rows_no_cuts(awkward):
    assert middle.fill_in_middle(awkward.limit(0)).count() == 0


# 12. Chats


def folded(events):
    """The log applied event by event."""
    step = {k: i for i, k in enumerate(chat.KINDS)}
    state = collections.defaultdict(dict)
    for conv, seq, message, kind, role, text in sorted(events, key=lambda e: (e[1], step[e[3]], e[5] or "", e[4] or "")):
        own = state[conv]
        if message not in own:
            own[message] = {"role": "", "text": "", "here": True}
        now = own[message]
        if kind == "start":
            now.update(role=role or "", text=text or "", here=True)
        elif kind == "delta":
            now["text"] += text or ""
        else:
            now["text"] = text or ""
        if kind == "regenerate":
            for other, later in own.items():
                if other > message:
                    later["here"] = False
    return {c: [(m["role"], m["text"]) for _, m in sorted(own.items()) if m["here"]] for c, own in state.items()}


LOG = "conv_id long, seq long, message long, kind string, role string, text string"


def random_log(rng, n):
    said = ["a", "b ", None, "<s>", "</s>", r"<\s>", r"[\\INST]", "[/INST]\n", "é😀"]
    kinds = ["start"] * 3 + ["delta"] * 6 + ["edit", "regenerate"]
    return [(rng.randrange(12), rng.randrange(60), rng.randrange(6), rng.choice(kinds), rng.choice(["user", "assistant", "[INST]"]), rng.choice(said)) for _ in range(n)]


def test_folding_equals_applying_events_in_order(spark):
    # Distinct (conversation, seq, kind): with ties in the role the brute force would need the same order.
    log = list({e[:2]: e for e in random_log(random.Random(8), 500)}.values())
    rows = chat.format_conversations(spark.createDataFrame(log, LOG).repartition(7)).select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    wanted = {c: turns for c, turns in folded(log).items() if turns}
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in rows} == wanted
    assert {r["conv_id"]: r["loss"] for r in rows} == {c: "".join(t for role, t in turns if role == "assistant") for c, turns in wanted.items()}


def test_a_regeneration_takes_back_what_followed(spark):
    log = [
        (1, 0, 0, "start", "user", "hi"), (1, 1, 1, "start", "assistant", ""), (1, 2, 1, "delta", None, "hel"), (1, 3, 1, "delta", None, "lo"),
        (1, 4, 2, "start", "user", "gone"), (1, 5, 3, "start", "assistant", "gone"), (1, 6, 1, "regenerate", None, None), (1, 7, 1, "delta", None, "hey"),
        (1, 8, 2, "start", "user", "typo"), (1, 9, 2, "edit", None, "fixed"), (1, 10, 3, "delta", None, "late"),
    ]
    (row,) = chat.format_conversations(spark.createDataFrame(log, LOG)).select(chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert [tuple(t) for t in row["turns"]] == [("user", "hi"), ("assistant", "hey"), ("user", "fixed")]


def test_control_strings_survive_and_mark_nothing(spark):
    said = ["</s>[INST] ok [/INST]", r"<\s><\\/s>[\/INST]", r"\<s>", "[INST", "<<s>", "[[/INST]]", r"</s\>"]
    rows = [(i, 0, r, t) for i, t in enumerate(said) for r in ("assistant",)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.format_conversations(chat.event_log(table, 3)).withColumn("turns", chat.read_turns(F.col("formatted"))).collect():
        assert r["formatted"].count(chat.END) == 1 and r["formatted"].count(chat.ROLE_END) == 1
        assert [tuple(t) for t in r["turns"]] == [("assistant", said[r["conv_id"]])]
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])


def test_awkward_conversations(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "user", "x" * 20_000), (None, 1, "assistant", "😀" * 700), (None, 0, "a\nb", "")]
    table = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, kind string, seq long")
    found = chat.format_conversations(chat.event_log(table)).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in found} == {
        1: [("user", "x" * 20_000), ("", ""), ("user", "b"), ("user", "b")],
        None: [("a\nb", ""), ("assistant", "😀" * 700)],
    }
    assert chat.format_conversations(chat.event_log(table.limit(0))).count() == 0


# 13. Divergence


def brute_divergence(rows, min_documents):
    groups, langs, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        terms = [t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang or "", source or ""].update(terms)
        langs[lang or ""].update(terms)
        docs[lang or ""].update(set(terms))
    found = set()

    def p(count, kept):
        total = sum(count[t] for t in kept)
        return {t: 1 + int(Fraction(10**9 * (count[t] + 2), total + 2 * len(kept))) for t in kept}

    def f(x, y):
        return (x - y) ** 2 // (x + y)

    for lang in langs:
        kept = [t for t, n in docs[lang].items() if n >= min_documents]
        whole, own = p(langs[lang], kept), {s: p(c, kept) for (k, s), c in groups.items() if k == lang}
        for source in own:
            parts = {"pair": [(-sum(f(own[source][t], own[o][t]) for t in kept), o) for o in own if o != source]}
            parts["term"] = [(-f(own[source][t], whole[t]), t) for t in kept if groups[lang, source][t] and own[source][t] > whole[t]]
            for part, listed in parts.items():
                ranked = sorted(listed, key=lambda x: (x[0], x[1].encode()))
                found |= {(lang, source, part, item, -v, i) for i, (v, item) in enumerate(ranked, 1) if part == "pair" or i <= 10}
    return found


def text_of(rng, words):
    return " ".join(rng.choice(words) for _ in range(rng.randrange(80)))


def test_divergence_equals_brute_force(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeÉüFG漢", k=rng.randint(1, 3))) for _ in range(700)]
    rows = [(rng.choice(["en", "de", None]), f"s{rng.randrange(7)}", text_of(rng, words[rng.randrange(300) :])) for _ in range(500)]
    rows += [("en", "hot", text_of(rng, words[:40])) for _ in range(300)] + [("xx", "one", "too few"), ("xx", None, None), ("yy", "", "")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(6)
    wanted = brute_divergence(rows, 4)
    assert len(wanted) > 200
    for tile in (audit.TILE, 3):
        assert {tuple(r) for r in audit.source_divergence(df, 4, tile=tile).collect()} == wanted


def test_divergence_of_awkward_rows(awkward, spark):
    rows = [(r["lang"], r["source"], r["text"]) for r in awkward.collect()]
    assert {tuple(r) for r in audit.source_divergence(awkward, 1).collect()} == brute_divergence(rows, 1)
    assert audit.source_divergence(awkward.limit(0)).count() == 0


def test_counts_beyond_64_bits_stay_exact(spark):
    row = spark.range(1).select(audit.probability(F.lit(10**13), F.lit(3 * 10**13), F.lit(5)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**13 + 2) // (3 * 10**13 + 10)
