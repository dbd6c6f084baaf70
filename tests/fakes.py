"""Clients that plugins name in tests."""

import hashlib

from kiteloom.models import DescribedJudge, RuleExtractor


class Renderer:
    def pages(self, document, scale):
        if document == b"bad":
            raise ValueError("broken")
        for n, page in enumerate(document.decode().split("|"), 1):
            yield n, page.encode()


class Reader:
    def read(self, image):
        if image == b"dark":
            raise ValueError("nothing to see")
        return f"```markdown\n{image.decode()}\n```"


class Embedder:
    def embed(self, texts):
        return [[float(b) / 255 for b in hashlib.sha256(t.split("；")[1].removesuffix("协议").encode()).digest()[:8]] for t in texts]


class Judge(DescribedJudge):
    def judge(self, question):
        return '{"matched_indices": [0], "equivalent": true}' if "matched_indices" in question or "equivalent" in question else super().judge(question)


def renderer(config):
    return Renderer()


def reader(config):
    return Reader()


def extractor(config):
    return RuleExtractor()


def embedder(config):
    return Embedder()


def judge(config):
    return Judge()


def most_rows(spark):
    """A function that gives the most rows that came out of a step of the queries run since."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()

    def most():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        runs, found = store.executionsList(), [0]
        for i in range(before, runs.size()):
            run = runs.apply(i).executionId()
            said, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
            for k in range(nodes.size()):
                metrics = nodes.apply(k).metrics()
                for m in (metrics.apply(j) for j in range(metrics.size())):
                    v = said.get(m.accumulatorId())
                    if m.name() == "number of output rows" and v.isDefined():
                        found.append(int(v.get().replace(",", "")))
        return max(found)

    return most
