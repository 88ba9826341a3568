import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lullcast.llm.spelling import Numbering, common_prefix, spelling_groups


def brute_force(rows, drop_one_in=31):
    lower = {k: k + 32 for k in range(65, 91)}
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    forms, n_near = {}, {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        n_near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        form = forms[w]
        out.add((w, form, root, n, n_near[w], None if form is None else words[form]))
    return out


def variants(seed):
    """Texts of few words and their edits, frequencies far apart."""
    r = random.Random(seed)
    letters = "abÀÿ×"
    out = []
    for _ in range(12):
        word = "".join(r.choice(letters) for _ in range(r.randint(6, 10)))
        n = r.choice((2, 25, 260, 2700))
        for _ in range(4):
            out += [word] * n
            k, n = r.randrange(len(word)), max(2, n // 11)
            edit = r.choice(("", r.choice(letters), word[k] + r.choice(letters)))
            word = word[:k] + edit + word[k + 1 :]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed, part_words", [(1, 100_000), (2, 5), (3, 1)])
def test_equals_brute_force(spark, documents, seed, part_words):
    words = variants(seed)
    texts = [" ".join(words[k : k + 60]) for k in range(0, len(words), 60)]
    rows = [(i, t if i % 2 else t.replace("a", "A")) for i, t in enumerate(texts)]
    found = spelling_groups(documents([(i, t, "a") for i, t in rows]), part_words=part_words).collect()
    assert {tuple(r) for r in found} == brute_force(rows)
    assert len(found) == len({r.word for r in found})


def test_odd_rows(spark, documents, odd, words):
    doubled = [(900, "aaaaaaa aaaaaaaa aaaaaaaa aaaaaaa Ünïcode Ünïcode UNÏCODE, ünïcode", "a")]
    long = "xy" * 20_000
    doubled += [(901, f"{long} {long}z {long}", "a"), (902, f"{long}z", "b"), (None, "letters letters", "a")]
    rows = odd + doubled + doubled
    found = spelling_groups(documents(rows)).collect()
    assert {tuple(r) for r in found} == brute_force([(i, t) for i, t, _ in rows])


def test_nothing(documents):
    assert spelling_groups(documents([])).collect() == []
    assert spelling_groups(documents([(1, None, "a"), (2, "", "a"), (3, "once only", "a")])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab", max_size=6), min_size=1), st.sets(st.text("ab", max_size=4)))
def test_a_prefix_has_one_number_in_all_parts(words, split):
    split = sorted(split)
    numbers = {}
    for part in range(len(split) + 1):
        own = [w for w in sorted(words) if sum(b <= w for b in split) == part]
        numbering = Numbering(split)  # every part may be numbered by another task
        for w in own:
            path = numbering.path(part, w)
            assert len(path) == len(w) + 1
            for k, node in enumerate(path):
                assert numbers.setdefault(w[:k], node) == node
    assert len(set(numbers.values())) == len(numbers)


def test_common_prefix():
    assert common_prefix("abc", "abd") == 2
    assert common_prefix("", "a") == 0
    assert common_prefix("ab", "abc") == 2
