"""The two queries against a row-by-row computation, with hot keys."""

import datetime
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.fixtures import full
from tagloom.operators.posts import post_tags, response_times, with_author, with_tag
from tagloom.plans.low_scored_accepted import low_scored_accepted
from tagloom.plans.reputation_pairs import reputation_pairs
from tagloom.schemas import ENTITIES

START = datetime.datetime(2011, 1, 1)
POSTS = (
    "id long, post_type_id int, accepted_answer_id long, parent_id long, creation_date timestamp_ntz,"
    " score int, owner_user_id long, title string, tags string"
)


@pytest.fixture(scope="module")
def site():
    """A third of the answers go to one question, a third come from one author,
    most questions carry one tag."""
    random.seed(11)
    users = [(i, random.randrange(5000), f"user {i}") for i in range(40)]
    texts = ["<a><b>", "<a><b><c>", "<a>", "", None, "<b><a><a>", "<d><c><a><e>", "<x><y>", "<b>"]
    questions, answers = [], []
    for i in range(60):
        date = START + datetime.timedelta(milliseconds=random.randrange(10**10))
        accepted = random.choice([None, 1000 + random.randrange(400), 99999])
        questions.append((i, 1, accepted, None, date, 0, 1, f"Q{i}", random.choice(texts)))
    for i in range(400):
        parent = 7 if i % 3 == 0 else random.choice([None, random.randrange(70), 1005])
        owner = 3 if i % 3 == 1 else random.choice([None, random.randrange(60)])
        date = START + datetime.timedelta(milliseconds=random.randrange(10**10))
        answers.append((1000 + i, 2, None, parent, date, random.randrange(-5, 12), owner, "", ""))
    other = [(5000, 3, 1001, 7, START, -9, 3, "wiki", "<a><b>"), (5001, 1, 5000, None, START, 1, 3, "w", "<a>")]
    questions[7] = questions[7][:8] + ("<a><b><c>",)
    return questions + answers + other, users


@pytest.fixture(scope="module")
def tables(spark, site):
    posts = spark.createDataFrame(site[0], POSTS).repartition(6)
    users = spark.createDataFrame(site[1], "id long, reputation int, display_name string")
    return full(posts, ENTITIES["posts"]), full(users, ENTITIES["users"])


def tags_of(text):
    return [t for t in (text or "").replace("<", " ").replace(">", " ").split() if t]


def expected_pairs(site, min_count, tag=None):
    posts, users = site
    reputation = {u[0]: u[1] for u in users}
    asked = {p[0]: p for p in posts if p[1] == 1}
    groups = defaultdict(list)
    for a in posts:
        q = asked.get(a[3])
        if a[1] != 2 or q is None or a[6] not in reputation:
            continue
        minutes = (a[4] - q[4]) / datetime.timedelta(minutes=1)
        tags = tags_of(q[8])
        scope = tags if tag is not None else [None]
        for s in scope:
            for x in tags:
                for y in tags:
                    if x < y and s == tag and tag in (None, x):
                        groups[x, y].append((minutes, reputation[a[6]]))
    report = []
    for (x, y), values in groups.items():
        if len(values) < min_count:
            continue
        m, r = [v[0] for v in values], [v[1] for v in values]
        try:
            corr = statistics.correlation(m, r)
        except statistics.StatisticsError:
            corr = None
        deviation = statistics.stdev(m) if len(m) > 1 else None
        report.append((x, y, len(m), statistics.fmean(m), statistics.fmean(r), deviation, corr))
    return sorted(report, key=lambda row: (-row[2], row[3], row[0], row[1]))


def same(got, expected):
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert tuple(g)[:3] == e[:3]
        for a, b in zip(tuple(g)[3:], e[3:]):
            assert a == (b if b is None else pytest.approx(b, rel=1e-9, abs=1e-9))


@pytest.mark.parametrize("min_count, limit, tag", [(2, 20, None), (1, 3, None), (5, 20, "a"), (1, 20, "b")])
def test_reputation_pairs(spark, site, tables, min_count, limit, tag):
    expected = expected_pairs(site, min_count, tag)
    assert expected
    got = reputation_pairs(*tables, min_count=min_count, limit=limit, tag=tag).collect()
    same(got, expected[:limit])


def test_answers_without_a_date_count_but_do_not_weigh(spark, tables):
    posts, users = tables
    dated = reputation_pairs(posts, users, min_count=1, limit=None)
    late = posts.withColumn("creation_date", F.when(F.col("id") % 4 > 0, F.col("creation_date")))
    undated = reputation_pairs(late, users, min_count=1, limit=None)
    same_columns = ["tag1", "tag2", "pair_count", "avg_answerer_reputation"]
    assert sorted(dated.select(same_columns).collect()) == sorted(undated.select(same_columns).collect())
    times = response_times(late).where("response_time_minutes is not null")
    tagged = post_tags(posts).withColumnRenamed("post_id", "question_id")
    both = tagged.where("tag = 'a'").join(tagged.where("tag = 'b'"), "question_id")
    values = with_author(times, users).join(both, "question_id").select("response_time_minutes")
    minutes = [r[0] for r in values.collect()]
    row = undated.where("tag1 = 'a' and tag2 = 'b'").first()
    assert row["avg_response_time_minutes"] == pytest.approx(statistics.fmean(minutes))
    assert row["stddev_response_time"] == pytest.approx(statistics.stdev(minutes))


def test_reputation_pairs_without_limit(spark, site, tables):
    got = sorted(reputation_pairs(*tables, min_count=1, limit=None).collect())
    same(got, sorted(expected_pairs(site, 1)))


def test_the_split_of_the_rows_does_not_change_a_digit(spark, tables):
    posts, users = tables
    reports = {
        repr(reputation_pairs(posts.repartition(n), users).collect()) for n in (1, 3, 16)
    }
    assert len(reports) == 1


@pytest.mark.parametrize("max_score, limit, tag", [(5, 20, None), (-1, 20, None), (5, 20, "a"), (11, 4, None)])
def test_low_scored_accepted(spark, site, tables, max_score, limit, tag):
    posts, users = site
    answers = {p[0]: p for p in posts if p[1] == 2}
    known = {u[0]: u for u in users}
    found = []
    for q in posts:
        a = answers.get(q[2])
        if q[1] == 1 and a and a[5] <= max_score and a[6] in known:
            row = (a[0], q[0], q[7], a[5], a[4], *(known[a[6]][i] for i in (0, 2, 1)))
            found += [(row, q[4])] * (1 if tag is None else tags_of(q[8]).count(tag))
    found.sort(key=lambda f: (f[0][3], -f[1].timestamp(), f[0][0]))
    got = low_scored_accepted(*tables, max_score=max_score, limit=limit, tag=tag).collect()
    assert [tuple(r) for r in got] == [row for row, _ in found[:limit]]
    assert got


def test_a_join_to_post_tags_scopes_alike(spark, tables):
    posts, users = tables
    scoped = with_tag(posts.where("post_type_id = 1"), post_tags(posts), "a")
    assert scoped.columns == posts.columns
    rest = posts.where("post_type_id <> 1")
    got = low_scored_accepted(scoped.unionByName(rest), users, limit=None).collect()
    expected = low_scored_accepted(posts, users, limit=None, tag="a").collect()
    assert got and sorted(got) == sorted(expected)


def test_sites_are_written_side_by_side(spark, sf_dir, monkeypatch):
    from threading import Barrier

    import __spark_entry__ as e

    together, written = Barrier(4, timeout=60), []

    def write_with_others(df, entity, site_dir):
        together.wait()
        written.append((entity.file, site_dir))

    monkeypatch.setattr(e, "write_xml", write_with_others)
    dirs = e._site_dirs(spark, sf_dir, "users", "posts")
    assert sorted(written) == sorted((name, d) for name in ("Users", "Posts") for d in dirs)
