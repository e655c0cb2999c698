"""Operators against brute-force versions on small tables that hold every odd case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (
    decontamination,
    jaccard,
    line_spread,
    mixing,
    quality,
    secret_ledger,
    sharding,
    substrings,
    surrogates,
    toxicity,
)
from strata.llm.common import permute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def texts():
    """Rows (doc_id, text, lang, source, n_chars): near copies, shared passages, ties, nulls, blanks and long texts."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 60)
    rows = [base] * 4 + [base.upper(), base.replace(" ", "  ")]
    for _ in range(12):  # near copies, some of them in chains
        words = base.split()
        for at in rng.sample(range(120), rng.choice([1, 2, 3])):
            words[at] = f"x{rng.randrange(9)}"
        rows.append(" ".join(words))
    rows += [f"{prose(rng, rng.randrange(90))} {passage} {prose(rng, rng.randrange(90))}" for _ in range(8)]
    rows += [passage + " " + passage, "a b c d", "a b c d", "a b c d e", "a b c d e f", "A b c d e f g", "a", "", "", " \n\t ", None, None]
    rows += [" ".join(WORDS[i : i + n]) for i in (0, 3) for n in (9, 10, 11, 12, 18, 19)]
    rows += [prose(rng, 30_000), "été ÉTÉ \U0001f600 " * 30, "x" * 50_000, "same line\nsame line\nother\n\n\nsame line"]
    rows += [prose(rng, rng.randrange(1, 200)) for _ in range(20)]
    table = [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(rows)]
    return [*table, table[7], table[7], (None, base, None, None, 3), (None, "lonely words here", None, "s1", 4)]


@pytest.fixture(scope="module")
def docs(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(texts, SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crowded(df):
    """Extra columns whose names the operators use themselves."""
    names = "_row _key _digest digest key n size kept shingle _src _chunk _pos _words _text _line _doc _id row f pattern starts wanted found blob _spans".split()
    return df.select("*", *[F.lit(7).alias(n) for n in names])


def blank_words(text):
    return (text or "").encode().split()


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())


def test_permute_is_one_to_one(spark):
    for size in (1, 2, 7, 100, 1023):
        got = [r[0] for r in spark.range(size).select(permute(F.col("id"), F.lit(size), 3)).collect()]
        assert sorted(got) == list(range(size))
    assert got != sorted(got)


# 1


def brute_hits(text, items):
    words, hit, found = alnum_words(text), set(), set()
    for item, content in items:
        w = alnum_words(content)
        for i in range(max(len(w) - 10, 0) + 1) if w else ():
            window = w[i : i + 10]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def items_of(texts):
    by_id = {r[0]: r[1] for r in texts}
    return [(3, by_id[0][:200]), (20, by_id[18]), (20, by_id[1][50:120]), (5, "a b"), (6, "E"), (7, None), (8, ""), (None, "été ÉtÉ"), (9, by_id[0][:200])]


@pytest.mark.parametrize("broadcast", [True, False])
def test_contamination(spark, docs, texts, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    items = items_of(texts)
    got = decontamination.contamination(crowded(docs), spark.createDataFrame(items, "item_id long, text string"))
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect())
    few = [r for r in texts if len(r[1] or "") < 20_000]
    want = Counter((r[0], n, h, tuple(f)) for r in few for n, h, f in [brute_hits(r[1], items)])
    assert sum(got.values()) == len(texts) and not want - got


def test_clean_documents(spark, docs, texts, empty):
    items = spark.createDataFrame(items_of(texts), "item_id long, text string")
    kept = decontamination.clean_documents(crowded(docs), items)
    assert kept.columns == crowded(docs).columns
    assert kept.count() == sum(brute_hits(r[1], items_of(texts))[1] == 0 for r in texts if len(r[1] or "") < 20_000) + sum(
        len(r[1] or "") >= 20_000 and brute_hits(r[1], items_of(texts))[1] == 0 for r in texts)
    assert decontamination.clean_documents(docs, items.limit(0)).count() == len(texts)
    assert decontamination.contamination(empty, items).count() == 0


# 2


def test_surrogates_keep_format_and_identity():
    key = b"k"
    made = {v: surrogates.surrogate(key, "card", v, 0) for v in ("4041894974608795", "4111111111111111")}
    assert made["4111111111111111"][-1] == surrogates.check_digit(made["4111111111111111"][:-1])
    assert surrogates.in_format("4111-1111-1111-1111", made["4111111111111111"], "card").count("-") == 3
    assert re.fullmatch(r"[a-z]{3}\d@[a-z]+\d\.[a-z]+\.org", surrogates.surrogate(key, "email", "abc1@host2.site.org", 0))
    assert surrogates.surrogate(key, "given latin f", "anna", 0).title() in surrogates.GIVEN["latin", "f"]
    assert surrogates.surrogate(key, "address", "10.1.2.3", 0).startswith("10.")
    kinds = {k for *_, k, _ in surrogates.detect("Mrs Anna Smith met Иван Петров, a@b.com, 1.2.3.4, +1 (988) 555-2485.")}
    assert kinds == {"given latin f", "surname latin", "given cyrillic m", "surname cyrillic", "email", "address", "phone"}


@pytest.mark.parametrize("text", ["(John Smith)", '"Anna Meier said', '"Mr. Jones left', "(Mrs. Smith)", "see:Mr Jones", "a/John Smith", "«госпожа Петрова»", "[Иван Петров]", "-Mr. Jones", "1.José Díaz"])
def test_names_behind_punctuation(text):
    assert any(kind.startswith("surname") for *_, kind, _ in surrogates.detect(text))


def test_no_name_is_passed_over():
    rng = random.Random(8)
    parts = ["Mr", "Mr.", "госпожа", "John", "José", "Анна", "Smith", "Петрова", "x", "é", "1", "²", "_", "-", "'", " ", " ", "(", "«", ".", "\n", "\u0301"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=8))
        words = set(surrogates.LEADS.findall(text))
        assert not surrogates.TITLED.search(text) or words & surrogates.TITLE_WORDS
        assert not surrogates.NAMED.search(text) or words & surrogates.GENDER.keys()


@pytest.mark.parametrize(
    "text, names",
    [
        ("JOHN SMITH left", "JOHN SMITH"), ("Dr. Smith called", "Smith"), ("Priya Sharma wrote", "Priya Sharma"), ("Mr 王伟 spoke", "王伟"),
        ("John Smith left. Smith came back, and Smith's car", "John Smith Smith Smith"), ("Mr Παπαδόπουλος", "Παπαδόπουλος"), ("Dear Priya, hello", "Priya"),
        ("Dear Sir, the team says no", ""), ("MR SMITH", "SMITH"), ("My name is Wei Zhang. Zhang it is", "Wei Zhang Zhang"), ("Mr שמעון כהן", "שמעון כהן"),
        ("The King said so", ""), ("госпожа Петрова. Петрова", "Петрова Петрова"), ("mr smith", ""), ("Prof. Anna Meier-Schulz", "Anna Meier-Schulz"), ("Mr", ""),
    ],
)
def test_names_and_their_scripts(text, names):
    found = surrogates.detect(text)
    assert " ".join(text[a:b] for a, b, *_ in found) == names
    for a, b, kind, value in found:
        made = surrogates.in_format(text[a:b], surrogates.surrogate(b"k", kind, value, 0), kind)
        assert surrogates.script_of(made) == surrogates.script_of(text[a:b]) == kind.split()[1]
        assert made.isupper() == text[a:b].isupper() and made[0].isupper() == text[a].isupper()


@pytest.mark.parametrize("text, phone", [("call 555-123-4567 now", "555-123-4567"), ("(555) 123-4567", "(555) 123-4567"), ("tel. 01 23 45 67 89.", "01 23 45 67 89"), ("0171/1234567", "0171/1234567"), ("020 7946 0123", "020 7946 0123"), ("v 123.456.7890.1", ""), ("1-555-123-45678", ""), ("0.1234567", "")])
def test_national_phones(text, phone):
    found = surrogates.detect(text)
    assert [text[a:b] for a, b, *_ in found] == [phone] * bool(phone)
    for a, b, kind, value in found:
        made = surrogates.in_format(phone, surrogates.surrogate(b"k", kind, value, 0), kind)
        assert kind == "phone" and re.sub(r"\d", "0", made) == re.sub(r"\d", "0", phone) and (made[0] == "0") == (phone[0] == "0")


def test_kinds_of_names_share_no_surrogates():
    for script in ("latin", "cyrillic", "greek", "cjk", "hebrew", "arabic", "hangul"):
        pools = [set(map(str.casefold, surrogates.given_names(script, g))) for g in "mfn"]
        assert all(pools) and not any(a & b for a, b in combinations(pools, 2))
        assert len({len(x) for x in surrogates.syllables(script)}) == 1 and len(set(surrogates.syllables(script))) == len(surrogates.syllables(script))


def test_planted_entities_are_found_and_replaced_consistently(spark):
    """Labelled recall: of entities planted in sentences of several forms, at least nine in ten leave the text."""
    rng = random.Random(12)
    given = [rng.choice(surrogates.GIVEN["latin", g]) for g in "mf" for _ in range(30)] + ["Priya", "Wei", "Chidi", "Aiko", "Yusuf", "Leila"] * 5
    last = [f"{a}{b}" for a in ("Brad", "Kow", "Oka", "Sing", "Fern", "Lund") for b in ("ley", "alski", "for", "hania", "andez", "qvist")]
    forms = ["{g} {s} wrote a note", "Dr. {s} was there and {s} left", "My name is {g} {s}.", "Name: {g} {s}", "Mr {g} {s} and Mr {s}", "MRS {S} CAME", "it was {g} {s} again", "seen by {g} {s}"]
    rows, wanted = [], []
    for i in range(400):
        g, s = rng.choice(given), rng.choice(last)
        phone = rng.choice(["555-{:03}-{:04}", "+1 (555) {:03}-{:04}", "0{:03}/555{:04}"]).format(rng.randrange(1000), rng.randrange(10_000))
        mail = f"{s.lower()}{i}@mail.example.org"
        form = rng.choice(forms)
        rows.append((i, f"{prose(rng, 30)}\n{form.format(g=g, s=s, S=s.upper())} {prose(rng, 9)} at {phone} or {mail} {prose(rng, 40)}"))
        wanted += [(i, x) for x in (s, phone, mail)] + [(i, g)] * ("{g}" in form)
    got = {r.doc_id: r.text for r in surrogates.replace_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    gone = [x.casefold() not in got[i].casefold() for i, x in wanted]
    assert sum(gone) / len(gone) >= 0.9
    assert all(gone[k] for k, (_, x) in enumerate(wanted) if any(c.isdigit() for c in x))
    again = {re.search(r"Dr\. (\S+) was there and (\S+) left", t).groups() for t in got.values() if "was there" in t}
    assert again and all(a == b for a, b in again)


def test_personal_data_of_text_ids(spark):
    df = spark.createDataFrame([("a", "Mr Jones of x@y.org"), ("b", None), (None, "nothing")], "doc_id string, text string")
    got = {r.doc_id: (r.n_entities, r.text) for r in surrogates.replace_personal_data(df, b"k").collect()}
    assert got["a"][0] == 2 and "Jones" not in got["a"][1] and got["b"] == (0, "") and got[None] == (0, "nothing")


def test_replace_personal_data(spark, empty):
    rows = [(1, "Mr. John Smith wrote to a.b@c.org and A.B@C.ORG. Mr Smith waits."), (2, "call 4111 1111 1111 1111 or 4111111111111111"),
            (3, None), (4, ""), (4, ""), (5, "nothing here"), (None, "x@y.z 10.0.0.1"), (6, "JOHN SMITH " + "word " * 9000 + "John Smith")]
    rows += [(100 + i, f"Mr {name} Stone and Mr {name}y Stone{'abcdefghij'[i % 10]}k") for i, name in enumerate(surrogates.GIVEN["latin", "m"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in surrogates.replace_personal_data(crowded(df), b"k").collect()}
    assert len(got) == len({r[0] for r in rows}) and got[3] == got[4] == "" and got[5] == "nothing here"
    first = re.fullmatch(r"Mr\. (\w+(?:-\w+)*) (\w+) wrote to (\S+)@(\S+) and (\S+)@(\S+)\. Mr (\w+) waits\.", got[1]).groups()
    assert first[1] == first[6] and "Smith" not in got[1] and first[2].upper() == first[4] and first[0] in got[6]
    assert got[2].split(" or ")[0][5:].replace(" ", "") == got[2].split(" or ")[1][-16:]
    again = {r.doc_id: r.text for r in surrogates.replace_personal_data(df, b"k").collect()}
    assert again == got and surrogates.replace_personal_data(empty, b"k").count() == 0
    entities = spark.createDataFrame([(f"given latin {g}", f"{n}{i}") for g in "mf" for n in ("ann", "bob") for i in range(60)], "kind string, value string")
    chosen = surrogates.choose_surrogates(entities, b"k").collect()
    assert len({(r.kind, r.made) for r in chosen}) == len(chosen) == 240
    assert not {(r.kind, r.made) for r in chosen} & {(r.kind, r.value) for r in chosen}


FORMS = [("phone", "+25**"), ("phone", "***"), ("email", "a0._@q.org"), ("email", "_@q.org"), ("address", "192.168.*.*"), ("address", "10.*.*.*"),
         ("address", "*.*.*.*.*"), ("card", "4" + "*" * 12 + "!"), ("card", "4" + "*" * 12), ("number", "***-**-****"), ("given latin f", "*"),
         ("given cyrillic m", "*-*"), ("given hebrew n", "*"), ("surname cjk", "***"), ("surname latin", "***"), ("surname cyrillic", "****")]


@pytest.mark.parametrize("kind, shape", FORMS)
def test_values_of_formats_are_distinct(kind, shape):
    for _ in range(3):
        n = surrogates.size_of(kind, shape)
        at = list(range(n)) if n < 5000 else [*range(2000), *range(n - 2000, n)]
        made = [surrogates.value_at(kind, shape, i) for i in at]
        assert len(set(made)) == len(at) and {surrogates.form(kind, x) for x in made} == {shape}
        shape = surrogates.wider(kind, shape)
        assert surrogates.size_of(kind, shape) >= n


def test_full_formats_are_settled(spark):
    values = [("phone", f"+25{i:02}") for i in range(100)] + [("phone", f"+36{i:02}") for i in range(30)] + [("phone", "+2511")]
    values += [("email", f"{c}@x.org") for c in "abcdefghijklmnopqrstuvwxyz0123456789_"] + [("email", f"_@{c}.org") for c in "abcdefghijklmnopqrst"]
    values += [("given cyrillic m", f"имя{'абвгдежзик'[i % 10]}{i}") for i in range(300)] + [("address", f"192.168.{i}.{j}") for i in range(1, 255) for j in range(1, 255)]
    chosen = surrogates.choose_surrogates(spark.createDataFrame(values, "kind string, value string"), b"k", most=3)
    got = {(r.kind, r.value): r.made for r in chosen.collect()}
    again = {(r.kind, r.value): r.made for r in surrogates.choose_surrogates(chosen.select("kind", "value"), b"k", most=3).collect()}
    assert got == again and got.keys() == set(values)
    made = {(k, m) for (k, _), m in got.items()}
    assert len(made) == len(got) and not made & got.keys()
    # Free values come first: 50 of 80 for +36dd, none for +25dd, which gets one more digit.
    assert all(len(got["phone", f"+36{i:02}"]) == 5 for i in range(30)) and {len(got["phone", f"+25{i:02}"]) for i in range(100)} == {6}
    assert all(m.startswith("10.") for (k, _), m in got.items() if k == "address")
    assert surrogates.in_format("+25 (00)", "+25314", "phone") == "+25 (31)4"


# 3


@pytest.mark.parametrize("bits", [4, 12])
def test_spread_lines(spark, bits, empty):
    rng = random.Random(1)
    lines = [f"line {i}" for i in range(40)]
    rows = [(i, "\n".join(rng.choices(lines[: 1 + i % 40], k=6)) + "\n\n", None if i % 13 == 0 else f"s{rng.randrange(14)}") for i in range(300)]
    rows += [(7, None, "s1"), (8, "", "s2"), rows[3], rows[3]]
    sites = {}
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            if x.strip() and s is not None:
                sites.setdefault(x, set()).add(s)
    bad = {x for x, s in sites.items() if len(s) >= 10}
    assert bad and len(bad) < len(sites)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if bits != 12:
        assert line_spread.spread_lines(df, bits=bits).count() == len(bad)
        return
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in line_spread.without_spread_lines(crowded(df)).collect())
    split = [(i, (t or "").split("\n")) for i, t, _ in rows]
    assert got == Counter((i, len(x), sum(y in bad for y in x), "\n".join(y for y in x if y not in bad)) for i, x in split)
    assert line_spread.without_spread_lines(empty).count() == 0


# 4


def brute_components(texts):
    sets = []
    for row in texts:
        w = (row[1] or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 5, 0) + 1)} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for i, row in enumerate(texts):
        if row[0] is not None:
            least[find(i)] = min(row[0], least.get(find(i), row[0]))
    return [(row[0], len(s), least.get(find(i)) if s else row[0]) for i, (row, s) in enumerate(zip(texts, sets, strict=True))]


@pytest.mark.parametrize("boundary", [None, 0, 24])
def test_jaccard_components(docs, texts, monkeypatch, boundary):
    if boundary is not None:
        monkeypatch.setattr(jaccard, "pick_boundary", lambda *_: boundary)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_documents(crowded(docs)).collect())
    assert got == Counter(brute_components(texts))


def test_one_of_each(docs, texts, empty):
    got = jaccard.one_of_each(crowded(docs))
    assert got.columns == crowded(docs).columns
    want = Counter(i for i, n, c in brute_components(texts) if not n) + Counter({c for _, n, c in brute_components(texts) if n})
    assert Counter(r.doc_id for r in got.collect()) == want
    assert jaccard.one_of_each(empty).count() == 0 and jaccard.link_documents(empty).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r.key: r.root for r in jaccard.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


# 5


def test_quality_features_and_verdicts(docs, texts, empty):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.score_quality(crowded(docs)).collect())
    want = Counter()
    for i, t, *_ in texts:
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        runs = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            dup += bool(line.encode().split()) and line in seen
            seen.add(line)
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(again), len(w) < 50 or 100 * len(again) > 50 * len(w))] += 1
    assert got == want
    kept = quality.good_documents(crowded(docs))
    assert kept.columns == crowded(docs).columns
    assert kept.count() == quality.score_quality(docs).filter("kept").count() > 0
    assert quality.score_quality(empty).count() == quality.good_documents(empty).count() == 0


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.7
    right = np.linspace(0.6, 0.95, len(quality.RULES))
    votes = np.where(rng.random((20_000, len(right))) < right, good[:, None], ~good[:, None])
    cast = np.where(rng.random(votes.shape) < 0.8, np.where(votes, 2, 1), 0)
    patterns, counts = np.unique(cast @ 3 ** np.arange(len(right)), return_counts=True)
    model = quality.fit(patterns, counts)
    assert abs(model.good - 0.7) < 0.03
    assert np.abs(model.right_on_good - right).max() < 0.04 and np.abs(model.right_on_bad - right).max() < 0.05


# 6


def test_secrets_and_ledger(spark, tmp_path, empty):
    texts = ['password = "abcdef1" token: x', "password: token: abcdefg", "AKIAABC AKIA" + "Z9" * 9 + " " + "a1" * 12 + " " + "f" * 23,
             "é\U0001f600 API_KEY=zzzzzzz", "", None, "secret=abcdefg" * 3, "api-key=abcdefgh api_key:abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "x" * 50_000 + " token=" + "k" * 70_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, texts[0]), (51, texts[0]), (51, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ledger = str(tmp_path / "ledger")
    first = ("assign@1", "access@1")
    assert secret_ledger.scan(crowded(df), ledger, first).count() == len({t or "" for t in texts})
    assert secret_ledger.scan(df, ledger, first).count() == 0
    assert {tuple(r.rules) for r in secret_ledger.scan(df, ledger).collect()} == {tuple(r for r in secret_ledger.RULES if r not in first)}
    more = spark.createDataFrame([(60, "token=abcdefgh"), (61, texts[0])], df.schema)
    assert secret_ledger.scan(more, ledger).count() == 1
    found = secret_ledger.findings(crowded(df), ledger)
    got = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r._spans if s.kind in secret_ledger.BASE_KINDS)) for r in found.collect())

    def brute(text):
        a = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
        out = [(m.start(), 0, "assign", m.end()) for m in a.finditer(text) if len(m[2]) >= 6]
        out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
        return tuple((k, s, e) for s, _, k, e in sorted(out))

    assert got == Counter((i, brute(t or "")) for i, t in rows)
    assert secret_ledger.scan(empty, str(tmp_path / "none")).count() == 0
    assert secret_ledger.findings(empty, str(tmp_path / "none")).count() == 0


# 7


def test_mixing_meets_targets(spark, docs, texts, empty):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(20, 400)), rng.choice("aaaaaabbc") if i % 7 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(df, block=32, shard_slots=256)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    names = sorted((s for s in sizes if s), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want, fixed = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in fixed)
        share = {s: left * weight[s] / sum(weight[x] for x in names if x not in fixed) for s in names if s not in fixed}
        over = {s for s, x in share.items() if x > 2 * sizes[s]}
        if not over:
            break
        fixed |= over
    want = {s: share.get(s, 2.0 * sizes[s]) for s in names}
    got = {r._source: (r._words, r.target) for r in plan.sources.collect()}
    assert {s: x[0] for s, x in got.items()} == dict(sizes)
    assert all(abs(got[s][1] - want[s]) < 1e-6 * want[s] for s in names)
    taken = {r._src: r.n for r in plan.taken().groupBy("_src").agg(F.sum("_len").alias("n")).collect()}
    assert all(abs(taken[i] - want[s]) < 0.05 * want[s] for i, s in enumerate(names))
    assert plan.slots.groupBy("_src", "_block").count().filter("count > 2").isEmpty()
    counts = plan.slots.groupBy("shard").count().collect()
    assert all(r["count"] <= 256 for r in counts)
    mixed = mixing.mixed_documents(crowded(docs).withColumn("source", F.col("source")), block=16)
    assert mixed.columns == crowded(docs).columns
    by_id = {r[0]: r[1] for r in texts}
    for r in mixed.select("doc_id", "text", "n_chars").collect():
        assert r.n_chars == len(r.text) and (r.text == by_id[r.doc_id] or Counter(r.text.encode().split()) <= Counter(blank_words(by_id[r.doc_id]))) if r.doc_id is not None else True
    assert mixing.mixed_documents(empty).count() == 0
    no_words = spark.createDataFrame([(1, None, "a"), (2, "", None)], df.schema)
    assert mixing.mix(no_words).taken().count() == 0


def test_mixing_draws_small_sources(spark):
    small, large = 100, 600
    need = F.when(F.col("id") % 7 == 3, 12.0).otherwise(1500.0)
    sources = spark.range(700).select(F.col("id").alias("_src"), need.alias("_need"), F.lit(10_000).cast("long").alias("_blocks"))
    total = small * 12 + large * 1500
    slots = mixing.draw(sources, float(total), 512, 2, 717)
    got = {r._src: r["count"] for r in slots.groupBy("_src").count().collect()}
    assert sum(got.values()) == total and len(got) == small + large
    # As many as expected, and scattered as draws are.
    few = [n for s, n in got.items() if s % 7 == 3]
    assert abs(sum(few) - 12 * small) < 5 * (12 * small) ** 0.5
    assert 0.5 < sum((n - 12) ** 2 / 12 for n in few) / small < 1.6


@pytest.mark.parametrize("broadcast", [True, False])
def test_mixing_takes_any_number_of_sources(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(mixing, "GRID_BITS", 4)  # more sources than cells
    rng = random.Random(4)
    rows = [(i, prose(rng, 20), f"s{i:04}" if i < 4499 else None) for i in range(4500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(df, block=8, shard_slots=64)
    assert plan.sources.count() == 4500
    drawn = {r._src: r["count"] for r in plan.slots.groupBy("_src").count().collect()}
    # Weights 3, 1, 2: two passes of 20 words, and 50 words in the ratio of 1 to 2, in three blocks each.
    for part, want in ((0, 6.0), (1, 2.5), (2, 5.0)):
        counts = [drawn.get(s, 0) for s in range(part, 4500, 3)]
        # Draws beyond two passes of three blocks are left out.
        mean = sum(min(n, 6) * np.exp(-want) * want**n / math.factorial(n) for n in range(40))
        assert abs(sum(counts) / len(counts) - mean) < 0.04 * mean
    assert plan.docs.select("doc_id").distinct().count() == 4500 and plan.docs.filter("size != 20").isEmpty()
    mixed = mixing.mixed_documents(df, block=8, shard_slots=64)
    assert mixed.select("doc_id").distinct().count() > 4200


# 8


def brute_kept(texts):
    words = [blank_words(r[1]) for r in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for row, w in zip(texts, words, strict=True):
        gone = {i + j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(35)}
        out.append((row[0], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("shard_words", [2_000, 100])
def test_repeated_passages(docs, texts, shard_words, empty):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(crowded(docs), shard_words=shard_words).collect())
    assert got == Counter(brute_kept(texts))
    if shard_words > 100:
        assert substrings.without_repeats(empty).count() == 0


def test_passages_of_one_anchor_are_split_until_they_fit(spark):
    """Many different passages around one line: all share its gram, and few of them repeat."""
    rng = random.Random(8)
    line = "the one line that all of these pages hold in common today".split()
    texts = [" ".join([f"a{rng.randrange(5000)}" for _ in range(30)] + line + [f"b{rng.randrange(5000)}" for _ in range(30)]) for _ in range(300)]
    texts += [f"start {t} end" for t in texts[:40]]
    rows = [(f"p{i}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(df, shard_words=1_500).collect())
    assert got == Counter(brute_kept(rows))


def test_routes_are_the_smallest_grams():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2**63, 90, dtype=np.uint64)
    words[40:60] = words[40]  # windows with fewer different grams
    grams = substrings.rolling(words, 8)
    for depth in (1, 2, 40):
        sets = [tuple(sorted(set(grams[i : i + 28].tolist()))[:depth]) for i in range(56)]
        routes = substrings.further_routes(words, 35, depth).tolist()
        assert len(set(routes)) == len(set(sets)) == len(set(zip(routes, sets, strict=True)))


def test_fm_index_counts():
    rng = np.random.default_rng(2)
    tokens = np.append(rng.integers(1, 6, 3_000), 0)
    index = substrings.FMIndex(tokens, np.ones(len(tokens), int), 36)
    ends = np.arange(40, 3_000, 7)
    got = index.matches(tokens, ends, 12)
    for e, n in zip(ends, got, strict=True):
        runs = Counter(tuple(tokens[i : i + k]) for k in (n, n + 1) for i in range(len(tokens) - k + 1))
        assert n == 0 or runs[tuple(tokens[e - n + 1 : e + 1])] > 1
        assert n == 12 or runs[tuple(tokens[e - n : e + 1])] == 1


# 9


def test_toxicity_learns_and_catches_misspellings(spark, empty):
    rng = random.Random(4)
    bad = ["stupidity", "idiotic", "worthless"]
    rows, labels = [], []
    for i in range(900):
        words = prose(rng, rng.randrange(20, 80)).split()
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(2000, "w1 w2 stupidityy w3 w4 w5 w6 w7"), (2001, "w1 w2 w3 w4 w9 w5 w6 w7"), (2002, None), (2003, ""), (2003, ""), (None, "w1"), (2004, "w1 " * 50_000)]
    labels += [(2002, 0), (None, 1), (5000, 1)]
    df, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(df, known)
    found = [(r.doc_id, r.score) for r in toxicity.score_toxicity(crowded(df), model).collect()]
    got = dict(found)
    assert len(found) == len(rows) and all(0 <= s <= 1 for _, s in found)
    out = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 3 == 0) for i in out]) > 0.95
    assert got[2000] > got[2001]
    assert toxicity.score_toxicity(empty, model).count() == 0
    nothing = toxicity.fit(empty, known.limit(0))
    assert all(r.score < 0.5 for r in toxicity.score_toxicity(df.limit(5), nothing).collect())


def test_toxicity_scores_are_averages_of_subword_bags(monkeypatch):
    """Every score by hand: rows of a bag, words of a text, softmax; in one slice or many, remembered or not."""
    settings = toxicity.Settings(buckets=257, grams=(3, 4))
    rng = np.random.default_rng(3)
    model = toxicity.Model(settings, rng.normal(size=257), rng.normal(size=257), rng.random(257) < 0.7, -0.3, 1.7, 0.2)
    model.known[0] = True
    texts = ["Plain words, Été", "", "a", "12 _ !", "x" * 3_000, "plain words été words", " ".join(WORDS), "\U0001d4d0bc \U0001f600 d"]

    def vector(word):
        of, bucket = toxicity.subwords([word], settings)
        marked = f"<{word}>"
        assert len(bucket) == 2 + sum(max(0, len(marked) - n + 1) for n in settings.grams) and not of.any()
        rows = [b for b in bucket.tolist() if model.known[b]]
        return np.mean(model.toward[rows]), np.mean(model.notice[rows])

    wanted = []
    for text in texts:
        found = [vector(w) for w in toxicity.words_in(text) or {""}]
        weights = [math.exp(n) for _, n in found]
        lean = sum(w * t for w, (t, _) in zip(weights, found, strict=True)) / sum(weights) + model.bias
        wanted.append(1 / (1 + math.exp(-(model.slope * lean + model.shift))))
    for at_once, remembered in ((1 << 20, 1000), (10, 1000), (10, 3), (1, 0)):
        monkeypatch.setattr(toxicity, "AT_ONCE", at_once)
        monkeypatch.setattr(toxicity, "REMEMBERED", remembered)
        score = model.scorer()
        np.testing.assert_allclose(score(texts), wanted, rtol=1e-9)
        np.testing.assert_allclose(score(texts[::-1]), wanted[::-1], rtol=1e-9)
        assert len(score([])) == 0


def test_toxicity_gradients():
    """One step of plain descent moves every parameter along the numeric slope of the loss."""
    settings = toxicity.Settings(buckets=12, width=3)
    state = toxicity.Training(np.random.default_rng(8), settings)
    state.values = {k: np.random.default_rng(9).normal(size=v.shape) for k, v in state.values.items()}
    bags, texts = [np.array([0, 3, 5]), np.array([0, 7]), np.array([0, 3, 3, 11])], [np.array([0, 1]), np.array([2]), np.array([0, 1, 2])]
    wanted = np.array([[1.0, 0.0], [0.0, 2.0], [0.5, 0.5]])

    def loss():
        v, total = state.values, 0.0
        for text, mass in zip(texts, wanted, strict=True):
            words = np.array([v["table"][bags[i]].mean(0) for i in text])
            weights = np.exp(words @ v["notice"])
            logits = weights @ words / weights.sum() @ v["softmax"] + v["bias"]
            total += mass.sum() * np.log(np.exp(logits).sum()) - mass @ logits
        return total / len(texts)

    grads = {}

    def keep(name, grad, rate, rows=slice(None)):
        grads[name] = np.zeros_like(state.values[name])
        grads[name][rows] = grad

    state.adam = keep
    state.fit(bags, texts, wanted, 0.1, weigh=True)
    for name, value in state.values.items():
        for at in np.ndindex(value.shape):
            before = value[at]
            value[at] = before + 1e-6
            up = loss()
            value[at] = before - 1e-6
            slope = (up - loss()) / 2e-6
            value[at] = before
            assert abs(slope - grads[name][at]) < 1e-5, (name, at)


def test_toxicity_sample_keeps_ids_that_follow_repeated_rows(spark, monkeypatch):
    """Rows and labels of small ids come many times; the toxic class has the large ids."""
    rows = [(i, f"w{i}") for i in range(40) for _ in range(30 if i < 20 else 1)]
    labels = [(i, int(i >= 20)) for i in range(40) for _ in range(3)]
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, settings: seen.update(zip(texts, labels, strict=True)) or toxicity.Model.__new__(toxicity.Model))
    monkeypatch.setattr(toxicity.Model, "slope", 0.0, raising=False)
    toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), toxicity.Settings(sample=20))
    learned = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert seen == {f"w{i}": int(i >= 20) for i in learned}


# 10


def test_shards_are_exact_and_repeatable(docs, texts, empty):
    got = sharding.shuffle_into_shards(crowded(docs).withColumn("shard", F.lit("old")), shards=7)
    assert got.columns == [*crowded(docs).columns, "shard", "slot"]
    rows = got.select("doc_id", "text", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in texts)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and sorted(by) == list(range(7))
    again = sharding.shuffle_into_shards(docs.repartition(3), shards=7).select("doc_id", "text", "shard", "slot")
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, rows))
    assert sharding.shuffle_into_shards(empty).count() == 0


def test_communication_matrix_has_exact_sums(spark):
    parts = spark.createDataFrame([(i, 10 + i) for i in range(9)], "_part long, _n long")
    rows = sum(10 + i for i in range(9))
    cells = sharding.communication_matrix(parts, 4, rows, 1).orderBy("_part", "_to").collect()
    assert {r._part for r in cells} == set(range(9))
    for part in range(9):
        starts = [r._lo for r in cells if r._part == part]
        assert starts[0] == 0 and starts == sorted(starts) and starts[-1] < 10 + part


def test_numbers_are_drawn_in_many_tasks(spark):
    parts = spark.range(40).selectExpr("id AS _part", "25 AS _n")
    cells = sharding.communication_matrix(parts, 4, 1000, 1)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    drawn = plan[plan.index("Generate explode") :]
    # Below the numbers there is an exchange by partition, and only below that the one task of all partitions.
    assert drawn.index("REPARTITION_BY_NUM") < drawn.index("Exchange SinglePartition")
    assert "Exchange SinglePartition" not in plan[: plan.index("Generate explode")]


def test_counts_follow_the_hypergeometric_law(spark):
    """Two partitions of three numbers and two shards: how many of the first three go to the first shard."""
    trials = spark.range(6000).select("id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("g"))
    to = F.pmod(permute(F.col("g"), F.lit(6), 77, F.col("id")), F.lit(2))
    seen = trials.groupBy("id").agg(F.count_if(to == 0).alias("k")).groupBy("k").count().collect()
    law = {0: 1 / 20, 1: 9 / 20, 2: 9 / 20, 3: 1 / 20}
    assert {r.k for r in seen} == set(law)
    assert all(abs(r["count"] / 6000 - law[r.k]) < 0.03 for r in seen)


def test_findings_of_other_rule_versions_do_not_count(spark, tmp_path):
    docs = spark.createDataFrame([(1, "password = hunter22"), (2, None)], "doc_id long, text string")
    ledger, text = str(tmp_path / "versions"), "password = hunter22"
    blob = hashlib.sha256(text.encode()).hexdigest()
    old = [(blob, ["assign@0"], [("assign@0", "assign", 3, 9)])]
    spark.createDataFrame(old, secret_ledger.LEDGER).write.parquet(ledger)
    assert {r.blob for r in secret_ledger.scan(docs, ledger, ("assign@1",)).collect()} == {blob, hashlib.sha256(b"").hexdigest()}

    def spans(*rules):
        return {r.doc_id: [(s.start, s.end) for s in r._spans] for r in secret_ledger.findings(docs, ledger, rules or ("assign@1",)).collect()}

    monkey = dict(secret_ledger.RULES)
    try:
        secret_ledger.RULES["assign@0"] = secret_ledger.RULES["assign@1"]
        assert spans("assign@0") == {1: [(3, 9)], 2: []}
    finally:
        secret_ledger.RULES.clear()
        secret_ledger.RULES.update(monkey)
    assert spans() == {1: [(0, 19)], 2: []}
    assert secret_ledger.scan(docs, ledger, ("assign@1",)).count() == 0


def test_lines_need_two_sites(docs):
    with pytest.raises(ValueError):
        line_spread.spread_lines(docs, min_sites=1)


def test_checksums(spark):
    assert spark.sql("select crc32(cast('abc' as binary)) c").first().c == zlib.crc32(b"abc")
    assert hashlib.sha256(b"").hexdigest() == spark.sql("select sha2('', 256) s").first().s
