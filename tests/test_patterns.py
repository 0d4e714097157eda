import random
import re

import pytest

from cashtide.operators.bursts import account_sessions, bursty_accounts, hourly_calendar, mention_spikes
from cashtide.operators.copies import copied_texts, near_copied_texts, similar_texts
from cashtide.operators.graph import connected

HOUR = 3_600_000_000


@pytest.fixture
def posts(spark):
    schema = "post_id string, source string, body string, root string, band int, text_key string"
    return lambda rows: spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))


def test_exact_copies(posts):
    rows = [("1", "a", "Buy  $GM\nnow"), ("2", "b", "buy $gm now "), ("3", "a", "buy $gm now"), ("4", "c", "other"), ("5", "c", "OTHER")]
    rows += [("6", None, "null account"), ("7", "d", "null account"), ("8", "e", ""), ("9", "f", None), ("10", "g", " \n"), (None, "a", "other")]
    got = {(r.posts, r.accounts, r.first_post) for r in copied_texts(posts(rows)).collect()}
    assert got == {(3, 2, "1"), (2, 2, "6"), (3, 2, "4")}
    assert copied_texts(posts([])).count() == 0 and copied_texts(posts(rows), min_accounts=3).count() == 0


def test_one_text_on_a_third_of_all_posts(posts):
    rows = [(str(i), f"s{i % 7}", "the same words" if i % 3 == 0 else f"text {i}") for i in range(900)]
    assert [tuple(r)[1:] for r in copied_texts(posts(rows)).collect()] == [(300, 7, "0")]


def brute_groups(texts, least=0.8, n=5):
    """``{id: smallest id of its component}``, all pairs compared."""
    def cut(text):
        words = text.lower().split()
        return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}

    sets = {i: cut(t) for i, t in texts.items()}
    root = {i: i for i in texts}
    find = lambda i: i if root[i] == i else find(root[i])
    for a in texts:
        for b in texts:
            if a < b and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in texts}


def edited(rng, text, edits):
    words = text.split()
    for k in rng.sample(range(len(words)), edits):
        words[k] = f"e{rng.randint(0, 10**6)}"
    return " ".join(words)


def grouped(found):
    groups = {}
    for r in found.collect():
        groups.setdefault(r.group_key, []).append(int(r.post_id))
    return {i: min(ids) for ids in groups.values() for i in ids}


def test_edited_copies_equal_brute_force(posts):
    rng = random.Random(1)
    texts = {i: prose(rng, rng.randint(1, 120)) for i in range(60)}
    base = prose(rng, 200)
    # Two copies are less alike than each is to the base: a third of all texts meets in its bands.
    texts |= {100 + i: edited(rng, base, 3) for i in range(40)} | {99: base, 150: base.upper()}
    chain = prose(rng, 150)
    for i in range(20):  # each like the one before, the ends are not alike
        chain = edited(rng, chain, 2)
        texts[200 + i] = chain
    rows = [(str(i), f"s{i % 5}", t) for i, t in texts.items()]
    want = brute_groups(texts)
    assert grouped(similar_texts(posts(rows))) == want and len({want[i] for i in texts if i >= 200}) == 1
    report = {(r.texts, r.posts, r.accounts) for r in near_copied_texts(posts(rows), min_accounts=5).collect()}
    assert report == {(41, 42, 5), (20, 20, 5)}


def test_edited_copies_of_nothing(posts):
    assert near_copied_texts(posts([])).count() == 0 and near_copied_texts(posts([("1", "a", None)])).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    root = {n: n for pair in links for n in pair if pair[0] != pair[1]}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = connected(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == root
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_keep_true_sizes(spark, capsys):
    """A size that each join multiplies has millions of digits after some rounds, which the driver's memory does not hold."""
    connected(spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long")).explain("cost")
    sizes = re.findall(r"sizeInBytes=([^,)]+)", capsys.readouterr().out)
    assert sizes and all(re.fullmatch(r"[\d.]+ (B|KiB|MiB)", size) for size in sizes), sizes


@pytest.fixture
def mentions(spark):
    return lambda rows: spark.createDataFrame([(t, us, 1, 2) for t, us in rows], "ticker string, time_us long, hour int, total int")


def brute_spikes(rows, k, d, least):
    counts = {}
    for ticker, us in rows:
        if us is not None:
            counts[ticker, us // HOUR] = counts.get((ticker, us // HOUR), 0) + 1
    first, last = min(h for _, h in counts), max(h for _, h in counts)
    out = []
    for ticker in {t for t, _ in counts}:
        for hour in range(first + k, last + 1):
            before = [counts.get((ticker, h), 0) for h in range(hour - k, hour)]
            n, s, q = counts.get((ticker, hour), 0), sum(before), sum(x * x for x in before)
            if n >= least and k * n > s and (k * n - s) ** 2 > d * d * (k * q - s * s):
                out.append((str(ticker), hour, n))
    return sorted(out)


def test_spikes_equal_brute_force(mentions):
    rng = random.Random(3)
    rows = [(rng.choice(["GM", "SPY", None]), rng.randint(0, 80) * HOUR + rng.randint(0, HOUR - 1)) for _ in range(700)]
    rows += [("GM", 40 * HOUR + i) for i in range(30)] + [("NEW", 60 * HOUR)] * 4 + [("OLD", -HOUR)] + [("GM", None)]
    got = sorted((str(r.ticker), int(r.hour.timestamp()) // 3600, r.mentions) for r in mention_spikes(mentions(rows), 12).collect())
    assert got == brute_spikes(rows, 12, 3, 3) and ("NEW", 60, 4) in got


def test_calendar_has_all_hours(mentions):
    got = {(r.ticker, r.hour): r.mentions for r in hourly_calendar(mentions([("A", 5 * HOUR), ("A", 5 * HOUR + 1), ("B", 8 * HOUR)])).collect()}
    assert got == {(t, h): {("A", 5): 2, ("B", 8): 1}.get((t, h), 0) for t in "AB" for h in range(5, 9)}
    assert hourly_calendar(mentions([])).count() == 0 and mention_spikes(mentions([])).count() == 0


def brute_sessions(rows, gap):
    out, times = [], {}
    for account, us in rows:
        if us is not None:
            times.setdefault(account, []).append(us)
    for account, all_us in times.items():
        run = []
        for us in sorted(all_us):
            if run and us - run[-1] > gap:
                out.append((str(account), run[0], run[-1], len(run)))
                run = []
            run.append(us)
        out.append((str(account), run[0], run[-1], len(run)))
    return sorted(out)


@pytest.mark.parametrize("gap", [HOUR // 2, 30 * HOUR])
def test_sessions_equal_brute_force(spark, gap):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), rng.randint(-200, 900) * HOUR // 4) for _ in range(900)]
    rows += [("edge", 0), ("edge", gap), ("edge", 2 * gap + 1), ("long", 0), *(("long", i * gap) for i in range(1, 200)), ("a", None)]
    df = spark.createDataFrame([(a, us, "x") for a, us in rows], "source string, time_us long, slot string")
    got = sorted((str(r.account), r.first_us, r.last_us, r.posts) for r in account_sessions(df, gap).collect())
    assert got == brute_sessions(rows, gap) and ("long", 0, 199 * gap, 200) in got


def test_bursts(spark):
    rows = [("bot", i * 1_000_000) for i in range(10)] + [("slow", i * HOUR // 3) for i in range(10)] + [("same", 7)] * 6
    df = spark.createDataFrame(rows, "source string, time_us long")
    got = {r.account: (r.posts, r.posts_per_minute) for r in bursty_accounts(df).collect()}
    assert got == {"bot": (10, 66.6667), "same": (6, 360.0)}
    assert bursty_accounts(df.limit(0)).count() == 0
