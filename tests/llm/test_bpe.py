import hashlib
import json
import random

import public_tokenizers
from tokenizers import Tokenizer

from lectio.llm import attribution as A
from lectio.llm import bpe_automaton as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ​　'sStTrevmldaé中文字١٢²Ⅷ½_-=#aaaabbb  \U0001F600́.,1234567890\x00"


def reference():
    return Tokenizer.from_file(PATH)


def test_automaton_equals_the_library():
    tokenizer, automaton = reference(), B.MergeAutomaton(B.read_definition(PATH), memory=2000)
    rnd = random.Random(11)
    texts = ["", " ", "a" * 3000, " " * 500, "<|endoftext|>", "x<|endoftext|><|endoftext|> y\n"]
    for i in range(6000):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.choice([1, 2, 3, 8, 30])))
        texts.append(text + "<|endoftext|>" + text[::-1] if i % 9 == 0 else text)
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text) == ids, text
        assert automaton.decode(ids).decode() == text == tokenizer.decode(ids, skip_special_tokens=False)


def test_gadgets_give_one_path_per_word():
    """On a small vocabulary: of all ways to spell a word with tokens, the
    automaton has arcs for exactly the one that merging in order gives."""
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "a"), ("aa", "aa"), ("ab", "ab"), ("b", "b")]
    vocab = {c: i for i, c in enumerate(B.byte_letters())}
    for u, v in merges:
        vocab[u + v] = len(vocab)
    automaton = B.MergeAutomaton(json.dumps({"model": {"vocab": vocab, "merges": [list(m) for m in merges]}}))

    def merged(word):
        parts = list(word)
        for u, v in merges:
            out = []
            for p in parts:
                if out and out[-1] == u and p == v:
                    out[-1] = u + v
                else:
                    out.append(p)
            parts = out
        return parts

    def spellings(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            if word[:n] in vocab:
                for rest in spellings(word[n:]):
                    yield [word[:n], *rest]

    for n in range(1, 9):
        for bits in range(2**n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            paths = [s for s in spellings(word)
                     if all(automaton.arc(vocab[x], vocab[y]) for x, y in zip(s, s[1:], strict=False))]
            assert paths == [merged(word)]
            assert automaton.accept(word.encode()) == [vocab[t] for t in merged(word)]


def test_documents(odd_docs, no_docs):
    tokenizer = reference()
    got = B.encode_documents(odd_docs, PATH).collect()
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    assert len(got) == odd_docs.count()
    for r in got:
        match = [t for t in texts[r.doc_id] if t == r.decoded]
        assert match
        ids = tokenizer.encode(match[0], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(match[0].encode()).hexdigest()
    assert B.encode_documents(no_docs, PATH).count() == 0


def brute_owner(tokens, spans, rule):
    """Owner span of every token, byte by byte."""
    at, out = 0, []
    for size in tokens:
        held = {}
        first = None
        for byte in range(at, at + size):
            s = next((k for k, (b, e) in enumerate(spans) if b <= byte < e), None)
            first = s if byte == at else first
            held[s] = held.get(s, 0) + 1
        at += size
        if rule == "first":
            out.append(first)
        else:
            top = max(held.values())
            out.append(next(k for k in [*range(len(spans)), None] if held.get(k) == top))
    return out


def test_attribution_against_brute_force(spark):
    automaton = B.MergeAutomaton(B.read_definition(PATH))
    rnd = random.Random(5)
    rows = []
    for i in range(120):
        text = "".join(rnd.choice("ab é\n\n中 the= ") for _ in range(rnd.randrange(60)))
        rows.append((i, rnd.choice([None, "", "web", "é中"]), text))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for rule in ("first", "most"):
        got = A.attribute_tokens(df, PATH, ("source", "text"), sections={"text": A.paragraphs}, rule=rule).collect()
        by = {}
        for r in got:
            by.setdefault(r.doc_id, {})[r.field, r.part] = r
        for i, source, text in rows:
            whole = (source or "") + "\n" + text
            ids = automaton.encode(whole)
            spans = [r for r in by[i].values() if r.begin is not None and r.end > r.begin]
            spans.sort(key=lambda r: r.begin)
            bounds = [(len(whole[:r.begin].encode()), len(whole[:r.end].encode())) for r in spans]
            owners = brute_owner([len(automaton.labels[t]) for t in ids], bounds, rule)
            for k, r in enumerate(spans):
                assert r.n_tokens == owners.count(k), (rule, whole, r)
            outside = by[i].get((None, None))
            assert (outside.n_tokens if outside else 0) == owners.count(None)
            assert sum(r.n_tokens for r in by[i].values()) == len(ids) == next(iter(by[i].values())).doc_tokens


def test_attribution_odd_rows(odd_docs, no_docs):
    got = A.attribute_tokens(odd_docs, PATH, ("source", "text")).collect()
    totals = {r.n_tokens for r in got if r.doc_id == 4 and r.field == "text"}
    assert totals == {0}
    assert sum(r.field == "text" for r in got) == odd_docs.count()
    assert A.attribute_tokens(no_docs, PATH).count() == 0
