import hashlib
import random
import re

from llm_cases import llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm.decontaminate import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def _brute(docs, items):
    out = []
    wins = {}
    for item, text in items:
        w = _words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[i:i + 13]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in wins}
    for d, t in docs:
        w = _words(t)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = wins.get(tuple(w[i:i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(d), len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def _rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def _case():
    rnd = random.Random(11)
    vocab = ["the", "of", "river", "Ähre", "été", "lamp", "x1", "zwölf"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.randint(14, 30))) for i in range(25)] + [(100, "rare two"), (101, "lonely"), (102, ""), (103, None), (104, "... !!"), (None, text(20)), (105, text(13))]
    items += [(106, items[0][1]), (0, items[0][1]), (107, " ".join(items[1][1].split()[3:])), (9, "Straße und"), (10, text(6))]
    docs = [(i, text(rnd.randint(0, 80))) for i in range(60)] + [(60, None), (61, ""), (62, "!!"), (None, items[2][1])]
    docs += [(200 + i, text(rnd.randint(0, 400)) + " ... " + rnd.choice(items[:25])[1].upper() + "! " + text(rnd.randint(0, 60))) for i in range(80)]
    docs += [(300, "a rare, TWO b"), (301, "lonely"), (301, "lonely"), (302, items[3][1] * 400), (303, "STRASSE Straße. und")]
    docs += [(500, text(2000) + " " + items[6][1])]
    docs += [(400 + i, " ".join(items[5][1].split()[:12 + i])) for i in range(3)]
    return docs, items


def test_against_brute_force(llm_spark, make_docs):
    docs, items = _case()
    bench = llm_spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as words", "1 as window_id")
    df = make_docs(docs, clash=True)
    want = _brute(docs, items)
    assert _rows(contamination(df, bench)) == want
    assert any(w[5] for w in want) and any(w[2] and not w[5] for w in want)
    kept = drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == [w[0] for w in want if not w[5]]


def test_odd_rows_and_empty_tables(llm_spark, make_docs, odd_rows):
    items = [(1, odd_rows[7][1]), (2, "one"), (3, odd_rows[8][1])]
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    assert _rows(contamination(make_docs(odd_rows), bench)) == _brute(odd_rows, items)
    none = llm_spark.createDataFrame([], "item_id long, text string")
    assert _rows(contamination(make_docs(odd_rows[:9]), none)) == _brute(odd_rows[:9], [])
    assert contamination(make_docs([]), bench).collect() == []
