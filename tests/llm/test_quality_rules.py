from collections import Counter

from conftest import make_docs, rows_of

from auric.llm import quality_rules as Q


def base(text):
    text = text or ""
    words = text.encode().split()
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), failed)


def test_measures_match_brute_force(corpus):
    got = Q.quality_rules(corpus).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                         "n_repeat_words", "base_failed")
    assert rows_of(got) == sorted(str((r.doc_id, *base(r.text))) for r in corpus.collect())


def test_base_failures_are_never_kept_and_rules_reject(spark):
    clean = "The quick fox met a lazy dog by the old stone bridge one day."
    texts = [clean, "w1### w2### " * 30, "SHOUTING WORDS ARE NOT GOOD PROSE FOR ANY READER AT ALL TODAY FRIENDS",
             "what! is! this! all! about! then! my! dear! old! friend! here!", "a b c d", None]
    rows = {r.doc_id: r for r in Q.quality_rules(make_docs(spark, list(enumerate(texts)))).collect()}
    assert rows[0].kept and not any(rows[i].kept for i in range(1, 6))
    assert rows[2].fail_bits & Q.BIT["upper_case"] and rows[3].fail_bits & Q.BIT["exclamations"]
    assert rows[4].base_failed and rows[5].fail_bits & Q.BIT["few_words"]


def test_policies_and_ablations_from_the_ledger(corpus):
    ledger = Q.ledger(Q.measure(corpus))
    bits = [r.fail_bits for r in ledger.collect()]
    got = {(r.version, r.rule): (r.n_failed, r.n_only) for r in Q.ablations(ledger).collect()}
    for p in Q.POLICIES:
        for name, bit in Q.BIT.items():
            if bit & p.mask and any(bits):
                assert got[p.version, name] == (sum(b & bit > 0 for b in bits), sum(b & p.mask == bit for b in bits))
    assert ledger.filter(Q.kept_by(Q.policy("v2"))).count() == sum(b & Q.policy("v2").mask == 0 for b in bits)


def test_empty_table_clashing_columns_and_accepted(corpus, clashing, empty):
    assert Q.quality_rules(empty).collect() == []
    assert rows_of(Q.quality_rules(clashing)) == rows_of(Q.quality_rules(corpus))
    kept = Q.accepted(clashing)
    assert kept.columns == clashing.columns
    assert rows_of(kept, "doc_id") == rows_of(Q.quality_rules(corpus).filter("kept"), "doc_id")
