import math
import zlib
from collections import Counter
from dataclasses import dataclass, field

import pytest

from prosewell.llm import url_models as um
from prosewell.llm.url_queries import ALLOW, BLOCK

ODD = [
    None, "", "no scheme", "http://", "http://Example.ORG", "http://example.org/es/1", "https://a.example.org/es",
    "https://a.example.org/en/123", "https://a.example.org/en/2?x=/es/", "http://notexample.org/es/1", "x://ÄB.com/fr/",
    "http://b.com/de/", "http://b.com?u=http://c.org/", "http://b.com#/fr/", "http://org/", "ftp://com/FR/", "http://n.net/ä\n?",
]


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min([i for i in map(path.find, "?#") if i >= 0], default=len(path))
    return host, path[:stop]


def rule(host, path):
    fits = []
    for r in ALLOW + BLOCK:
        name, _, rest = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(r)
    return max(fits, key=len, default=None)


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "key long, url string")


def test_hosts_paths_and_rules(spark):
    found = {r.key: r for r in um.judged(pages(spark, ODD * 2), ALLOW, BLOCK).collect()}
    assert len(found) == 2 * len(ODD)
    for i, url in enumerate(ODD * 2):
        host, path = parts(url)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule(host, path))
        assert found[i].verdict in ("allow", "block")
        if found[i].rule:
            assert found[i].verdict == ("allow" if found[i].rule in ALLOW else "block")


def test_one_kind_or_none(spark):
    assert um.judged(pages(spark, []), ALLOW, BLOCK).count() == 0
    of = lambda urls: {r.verdict for r in um.judged(pages(spark, urls), ALLOW, BLOCK).collect()}
    assert of(["http://a.net/"] * 3) == {"allow"}
    assert of(["http://a.net/", "http://b.com/de/1"]) == {"block"}
    assert of(["http://a.net/", "http://b.org/1"]) == {"allow"}


# A plain model, in memory, to hold the tables against.
@dataclass
class UrlModel:
    """n and kinds of what follows each context, and n of each follower."""

    contexts: dict[str, tuple[int, int]] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)

    def probability(self, context: str, char: str) -> float:
        p = 1.0 / um.SYMBOLS
        for k in range(len(context) + 1):
            seen = self.contexts.get(context[len(context) - k :])
            if seen is None:
                break
            n, kinds = seen
            p = (self.grams.get(context[len(context) - k :] + char, 0) + kinds * p) / (n + kinds)
        return p


@dataclass
class UrlFilter:
    accepted: UrlModel
    rejected: UrlModel
    threshold: float = 0.0

    def score(self, text: str, known: dict[str, float]) -> float:
        """Difference of log likelihoods by length; above 0: likelier accepted."""
        total = 0.0
        for at in range(um.ORDER, len(text)):
            gram = text[at - um.ORDER : at + 1]
            value = known.get(gram)
            if value is None:
                value = math.log(
                    self.accepted.probability(gram[:-1], gram[-1])
                    / self.rejected.probability(gram[:-1], gram[-1])
                )
                known[gram] = value
            total += value
        return total / (len(text) - um.ORDER)


def test_probabilities_sum_to_one():
    text = "abracadabra" * 3
    grams = Counter(text[i - k : i + 1] for i in range(5, len(text)) for k in range(6))
    contexts = {}
    for g, n in grams.items():
        total, kinds = contexts.get(g[:-1], (0, 0))
        contexts[g[:-1]] = (total + n, kinds + 1)
    model = UrlModel(contexts, dict(grams))
    for context in ("", "a", "abrac", "zzzzz", "zzbra"):
        seen = sum(model.probability(context, c) for c in "abrcd")
        other = model.probability(context, "z") * (um.SYMBOLS - 5)
        assert seen + other == pytest.approx(1)


def test_counts_equal_a_plain_count(spark):
    urls = [f"http://h{i % 3}.org/{i}" for i in range(50)] + [f"http://h{i % 3}.com/de/{i}" for i in range(50)]
    rows = [(um.ACCEPT if ".org" in u else um.REJECT, u) for u in urls]
    ruled = spark.createDataFrame(rows, "kind int, url string")
    found = um._counted.__wrapped__ if hasattr(um._counted, "__wrapped__") else um._counted
    grams = ruled.repartition(4).mapInArrow(found, "kind int, gram string, n long")
    got = {(r.kind, r.gram): r.n for r in grams.groupBy("kind", "gram").sum("n").toDF("kind", "gram", "n").collect()}
    want = Counter()
    for kind, url in rows:
        s = um.spelled(url)
        want.update((kind, s[i - k : i + 1]) for i in range(um.ORDER, len(s)) for k in range(um.ORDER + 1))
    assert got == want


def test_separates_what_the_rules_separate(spark):
    urls = [f"http://s{i}.good-site.org/article/{i}" for i in range(300)]
    urls += [f"http://b.com/de/cheap-pills-{i}" for i in range(300)]
    urls += ["http://x.net/article/5", "http://y.net/cheap-pills-9"]
    found = {r.key: r for r in um.judged(pages(spark, urls), ALLOW, BLOCK).collect()}
    assert found[600].verdict == "allow" and found[601].verdict == "block"
    assert math.isfinite(found[600].score)


def test_every_context_counts(spark):
    """The tables give what a plain model of all counted contexts gives, however rare the context."""
    urls = [f"http://s{i}.org/{i * 7919 % 1000}/x" for i in range(200)] + [f"http://t{i}.com/de/{i * 31}" for i in range(200)]
    urls += ["http://never.net/qqqq", "http://s1.net/5"]
    counts = {um.ACCEPT: Counter(), um.REJECT: Counter()}
    ruled = []
    for i, url in enumerate(urls[:400]):
        kind = um.ACCEPT if ".org" in url else um.REJECT
        ruled.append((kind, url, i))
        if zlib.crc32(str(i).encode()) % um.FOLDS != um.CALIBRATION:
            s = um.spelled(url)
            counts[kind].update(s[at - k : at + 1] for at in range(um.ORDER, len(s)) for k in range(um.ORDER + 1))
    models = []
    for kind in (um.ACCEPT, um.REJECT):
        contexts = {}
        for g, n in counts[kind].items():
            total, kinds = contexts.get(g[:-1], (0, 0))
            contexts[g[:-1]] = (total + n, kinds + 1)
        models.append(UrlModel(contexts, dict(counts[kind])))
    plain = UrlFilter(*models)
    table = um.context_table(spark.createDataFrame(ruled, "kind int, url string, key long"))
    assert table.count() == len(set(models[0].contexts) | set(models[1].contexts))
    found = {r.key: r.score for r in um.judged(pages(spark, urls), ALLOW, BLOCK).collect()}
    for i, url in enumerate(urls):
        assert found[i] == pytest.approx(plain.score(um.spelled(url), {}), abs=1e-8)


def test_the_whole_url_is_scored(spark):
    """The query string teaches and tells apart, and so do URLs without a scheme."""
    urls = [f"http://a.org/x?topic=science-{i}" for i in range(200)] + [f"http://a.com/de/x?buy=pills-{i}" for i in range(200)]
    urls += ["http://n.net/x?topic=science-7", "http://n.net/x?buy=pills-7", "topic=science-7", "buy=pills-7", None, ""]
    found = {r.key: r for r in um.judged(pages(spark, urls), ALLOW, BLOCK).collect()}
    assert [found[i].verdict for i in range(400, 404)] == ["allow", "block", "allow", "block"]
    assert found[402].host == found[403].path == "" and found[404].score == found[405].score
