import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from numprep.llm import components, dart_minhash, line_quality, textvec
from numprep.llm.line_quality import judge_documents, keep_good

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def failed(text):
    n, *_, repeated = counts(text)
    return n < 20 or 100 * repeated > 30 * n


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def normal(line):
    return " ".join(WORD.findall(fold(line)))


def check_counts(documents, rows):
    got = {(r.doc_id, r.host): r for r in judge_documents(documents(rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, source in rows:
        r = got[doc_id, source]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text), text
        assert r.base_failed == failed(text)
    return got


def test_counts_of_the_small_table(documents, sample):
    check_counts(documents, sample)


def test_counts_of_odd_texts(documents):
    draw = random.Random(5)
    parts = ["a", "b", "#", "é", "漢", "\n", "\n\n", " ", "\t", "\x0b", "\r\n", " ", "**", "🙂", "x y", "a b a b a b a b a b"]
    texts = [None, "", " ", "\n", "\n\n\n", "a", "a\n", "\na", "a " * 30, "ab\nab\n ab\nab"]
    texts += ["".join(draw.choices(parts, k=draw.randint(1, 60))) for _ in range(300)]
    check_counts(documents, [(i, t, draw.choice(["a", None])) for i, t in enumerate(texts)])


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))


def test_common_lines_against_brute_force(documents):
    draw = random.Random(7)
    shared = [words(draw, n) for n in (3, 12, 30, 40)]
    rows = []
    for i in range(240):
        lines = [words(draw, draw.randint(5, 30)) for _ in range(draw.randint(3, 6))]
        for s, often in zip(shared, (3, 6, 12, 6), strict=True):
            if i % often == 0:
                lines.append("  " + s.upper() if i % 2 else s)
        rows.append((i, "\n".join(lines), "ab"[i % 2]))
    rows += [(1000 + i, rows[0][1], "a") for i in range(40)]
    rows += [(2000 + i, f"{shared[1]}\n{words(draw, i)}", "ab"[i % 2]) for i in range(8, 30)]
    got = check_counts(documents, rows)
    having = defaultdict(set)
    for _, text, source in rows:
        for line in text.split("\n"):
            having[source, normal(line)].add(text)
    common = {k for k, texts in having.items() if len(texts) > line_quality.MAX_DOCUMENTS}
    assert 2 <= len(common) <= 8
    for doc_id, text, source in rows:
        n = len(WORD.findall(text))
        left = sum(len(WORD.findall(x)) for x in text.split("\n") if (source, normal(x)) not in common)
        r = got[doc_id, source]
        assert r.words_left == left
        assert r.kept == (not failed(text) and (left == n or (left >= 20 and left >= 0.2 * n)))
    kept = {r.doc_id: r.text for r in keep_good(documents(rows)).collect()}
    for doc_id, text, source in rows:
        if got[doc_id, source].kept:
            assert kept.pop(doc_id) == "\n".join(x for x in text.split("\n") if (source, normal(x)) not in common)
    assert not kept


def test_copies_and_near_copies_are_not_rejected(documents):
    draw = random.Random(9)
    base = [words(draw, 15) for _ in range(20)]
    rows = []
    for i in range(120):
        lines = list(base)
        for k in draw.sample(range(20), 3):
            lines[k] = lines[k][:-6] + "".join(draw.choices("xyz", k=6))
        rows.append((i, "\n".join(lines)))
    rows += [(200 + i, "\n".join(base)) for i in range(100)]
    assert all(r.kept and r.removed is None for r in judge_documents(documents(rows)).collect())


def test_a_line_of_unrelated_documents_is_removed_whatever_its_share(documents):
    rows = []
    for share in (25, 50, 80):
        for seed in range(30):
            draw = random.Random(100 * share + seed)
            shared = words(draw, 2 * share)
            rows += [(len(rows) + i, f"{words(draw, 200 - 2 * share)}\n{shared}", f"{share}-{seed}") for i in range(24)]
    got = judge_documents(documents(rows)).collect()
    assert len(got) == len(rows)
    assert not [(r.doc_id, r.host) for r in got if r.words_left != 200 - 2 * int(r.host.split("-")[0])]


def test_near_copies_do_not_hide_a_line_of_unrelated_documents(documents):
    draw = random.Random(17)
    footer = words(draw, 10)
    base = words(draw, 200).split()
    rows = [(0, f"{' '.join(base)}\n{footer}")]
    for i in range(1, 600):
        copy = list(base)
        for k in draw.sample(range(200), 3):
            copy[k] = words(draw, 1)
        rows.append((i, f"{' '.join(copy)}\n{footer}"))
    # The near copies are one document, so this host's footer stays.
    rows = [(*r, "copies") for r in rows] + [(1000 + i, text, "both") for i, text in rows]
    rows += [(2000 + i, f"{words(draw, 200)}\n{footer}", "both") for i in range(40)]
    got = judge_documents(documents(rows)).collect()
    assert len(got) == len(rows) and all(r.kept for r in got)
    assert not [(r.doc_id, r.host) for r in got if r.words_left != (210 if r.host == "copies" else 200)]


def test_lines_of_unrelated_documents_are_found_without_their_texts(documents, monkeypatch):
    def classes(docs):
        raise AssertionError("texts are compared")

    monkeypatch.setattr(line_quality, "classes", classes)
    draw = random.Random(19)
    footer = words(draw, 10)
    rows = [(i, f"{words(draw, 60)}\n{footer}", "a") for i in range(30)]
    assert all(r.kept and r.words_left == 60 for r in judge_documents(documents(rows)).collect())


def test_a_line_of_texts_with_like_signatures_that_are_no_copies_is_removed(documents):
    draw = random.Random(23)
    footer = words(draw, 10)
    base = words(draw, 300).split()
    rows = []
    for i in range(30):
        text = list(base)
        for k in draw.sample(range(0, 300, 10), 6):
            text[k] = words(draw, 1)
        rows.append((i, f"{' '.join(text)}\n{footer}", "a"))
    got = judge_documents(documents(rows)).collect()
    assert len(got) == 30 and all(r.kept and r.words_left == 300 for r in got)


def test_lines_of_near_copies_are_judged_in_one_pass_over_linear_tables(documents, monkeypatch):
    tables = []

    def stored(df, name, *more, real=line_quality.stored):
        out = real(df, name, *more)
        tables.append((name, out))
        return out

    for module in (line_quality, dart_minhash, components):
        monkeypatch.setattr(module, "stored", stored)
    draw = random.Random(29)
    footer = words(draw, 10)
    rows = []
    for k in range(30):  # classes of 12 near copies each
        base = words(draw, 150).split()
        for i in range(12):
            copy = list(base)
            copy[draw.randrange(150)] = words(draw, 1)
            rows.append((100 * k + i, f"{' '.join(copy)}\n{footer}", "a" if k < 8 else "b"))
    got = judge_documents(documents(rows)).collect()
    assert len(got) == len(rows) and all(r.kept for r in got)
    assert not [r for r in got if r.words_left != (160 if r.host == "a" else 150)]
    assert len(tables) <= 30
    counts = [(name, df.count()) for name, df in tables if "bucket" in df.columns]
    assert counts and all(n <= 32 * len(rows) for _, n in counts)
    assert sum(name == "members" for name, _ in counts) == 1


def test_empty_table_and_repeated_rows(documents):
    assert judge_documents(documents([])).collect() == []
    assert keep_good(documents([])).collect() == []
    row = (None, "one two " * 3 + "\n" + " ".join(map(str, range(40))), None)
    assert keep_good(documents([row] * 3)).count() == 3


def test_clashing_columns(documents):
    docs = documents([(1, " ".join(map(str, range(40))))])
    names = ("host", "text_key", "row", "removed", "lines", "n_words", "kept")
    for name in names:
        docs = docs.selectExpr("*", f"'x' as {name}")
    out = keep_good(docs)
    assert out.columns == docs.columns and out.collect() == docs.collect()


def _two_letter_word(n, flip):
    """Letters by the parity of the ones in their place: equal sums of powers modulo 2^64 for both ways round."""
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [256, 257, 1024, 4096])
def test_long_words_and_lines_that_hash_alike(n):
    one, other = _two_letter_word(n, 0), _two_letter_word(n, 1)
    text = "\n".join([one, other, " ".join([one] * 8), " ".join([other] * 8), one])
    data, offsets = textvec.utf8(pa.array([text]))
    measured = dict(zip(line_quality._COUNTS, (int(c[0]) for c in line_quality._measure(data, offsets))))
    assert measured["n_dup_lines"] == 1
    assert measured["n_repeat_words"] == 0
    hashes = line_quality.normal_lines(data, offsets)[-1]
    assert len(set(hashes.tolist())) == 4
    many = "\n".join(" ".join("xy"[(i.bit_count() + flip) % 2] for i in range(n)) for flip in (0, 1))
    assert len(set(line_quality.normal_lines(*textvec.utf8(pa.array([many])))[-1].tolist())) == 2
