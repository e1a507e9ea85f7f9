import re
from collections import Counter

from pressledger.llm.quality_rules import POLICIES, RULES, ablations, fails, ledger, mask
from pressledger.llm.tables import ready

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    covered = {j for i, w in enumerate(windows) if twice[w] > 1 for j in (i, i + 1, i + 2)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered), "n_lines": len(lines), "n_upper": sum("A" <= c <= "Z" for c in text)}


def bits(m):
    return sum(1 << i for i, (_, rule) in enumerate(RULES) if eval(rule, {}, m))  # noqa: S307


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a b c d a b c", "x " * 60, "one two\none two\n\none two", "### $$$ | <a>", "LOUD!! WORDS!! " * 40,
         "é日本 " * 30, "\r\n\x0b\x0ca\xa0b", "\n".join(f"line {i % 7} of text" for i in range(40)), " ".join(f"w{i}" for i in range(20000))]


def test_ledger_equals_brute_force(docs_of, spark):
    ready(spark)
    rows = list(enumerate(TEXTS)) + [(3, "a"), (None, "a b c a b c")]
    got = ledger(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        wanted = measured(TEXTS[r.doc_id] if r.doc_id is not None else "a b c a b c")
        assert {k: r[k] for k in wanted} == wanted and r.failure_bits == bits(wanted)
    assert ledger(docs_of(rows).where("false")).count() == 0


def test_ablations_equal_recounts(docs_of, spark):
    ready(spark)
    rows = list(enumerate(TEXTS * 3))
    every = [bits(measured(t)) for _, t in rows]
    got = {(r.policy, r.rule): r for r in ablations(ledger(docs_of(rows))).collect()}
    assert len(got) == sum(map(len, POLICIES.values()))
    for (policy, rule), r in got.items():
        own = 1 << [n for n, _ in RULES].index(rule)
        assert (r.n_docs, r.n_failing, r.kept) == (len(rows), sum(bool(b & own) for b in every), sum(not b & mask(policy) for b in every))
        assert r.n_only == sum(b & mask(policy) == own for b in every) and r.kept_without == sum(not b & mask(policy) & ~own for b in every)


def test_plan_is_native_and_narrow(docs_of, spark):
    plan = ledger(docs_of([(1, "a")])).select("*", fails("base"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("split(") == 2
