import re
from collections import Counter

from lectio.llm import quality_ledger as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures_match_brute_force(odd_docs):
    texts = [r.text for r in odd_docs.select("text").collect()]
    texts += ["a b c d e a b c d e", "a a a a a a", "x\nx\n x\n\n\n", "é ü\x85k \x1c q", "a b c d e f a b c d e f a b c d e"]
    for t in texts:
        assert Q.measure_text(t)[:5] == brute(t), t


def test_ledger_and_policies(odd_docs, no_docs):
    rows = Q.quality_ledger(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.failed_bits)
    assert by[1] == [0] and by[7] == [0] and by[3] == [0, 0]
    assert by[4] == [1] and by[5] == [1] and by[6] == [1]  # null, empty, blank: no words
    assert by[10][0] & 2 and by[12][0] & 4 and by[13][0] & 8
    assert Q.quality_ledger(no_docs).count() == 0


def test_keep_documents_keeps_all_columns(odd_docs, no_docs):
    kept = Q.keep_documents(odd_docs)
    assert kept.schema == odd_docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 3, 7, 8]
    assert Q.keep_documents(no_docs).count() == 0
    plan = Q.keep_documents(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # each rule's measurements come from one pass


def test_ablations_match_direct_counts(odd_docs, no_docs):
    ledger = Q.quality_ledger(odd_docs)
    bits = [r.failed_bits for r in ledger.collect()]
    mask = Q.policy_mask("corpus-2")
    got = {(r.policy, r.rule): r for r in Q.ablations(ledger).collect()}
    for i, rule in enumerate(Q.RULES):
        r = got["corpus-2", rule.name]
        assert r.n_fail == sum(bool(b >> i & 1) for b in bits)
        assert r.n_rejected == sum(bool(b & mask) for b in bits)
        assert r.n_only_this == sum(b & mask == 1 << i for b in bits)
    assert Q.ablations(Q.quality_ledger(no_docs)).count() == 0
