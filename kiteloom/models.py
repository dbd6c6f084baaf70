"""Interfaces to models, with what every call needs: settings, retries, a share of the request rate; and fakes for tests."""

from __future__ import annotations

import json
import re
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from .schema import ENTITY_TYPES


class Extractor(Protocol):
    def extract(self, text: str, prompt: str) -> str: ...


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Judge(Protocol):
    def judge(self, question: str) -> str: ...


class Reader(Protocol):
    def read(self, image: bytes) -> str: ...


class TransientError(Exception):
    """A failure that may pass: timeouts, lost connections, too many requests, server errors."""


def is_transient(error: BaseException | None) -> bool:
    """Whether the error, or one that caused it, may pass."""
    seen: set[int] = set()
    while error is not None and id(error) not in seen:
        seen.add(id(error))
        code = getattr(error, "status_code", None)
        if isinstance(error, (TransientError, TimeoutError, ConnectionError)) or code == 429 or isinstance(code, int) and 500 <= code < 600:
            return True
        error = error.__cause__ or error.__context__
    return False


def with_retries(call: Callable[[], object], attempts: int = 3, sleep: Callable[[float], None] = time.sleep):
    """Calls again after transient failures, after 1, 2, 4 ... and at most 30 seconds."""
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception as error:
            if n == attempts or not is_transient(error):
                raise
            sleep(min(2 ** (n - 1), 30))


class RateShare:
    """This task's part of a rate of calls: the cluster's calls a minute divided by its tasks.

    A limit over all executors at once cannot be kept without a service of its own; the parts add up to no more than it.
    With more tasks than calls a minute a task has one call in as many minutes as there are tasks for it.
    """

    def __init__(self, per_minute: int, tasks: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if per_minute < 1 or tasks < 1:
            raise ValueError("per_minute and tasks must be at least 1")
        self.most = max(1, per_minute // tasks)
        self.span = 60.0 if tasks <= per_minute else 60.0 * tasks / per_minute
        self.clock, self.sleep = clock, sleep
        self.free = [float("-inf")] * self.most  # when each place in a span is free again
        self.next = 0

    def acquire(self) -> None:
        place = self.next % self.most
        self.next += 1
        if (wait := self.free[place] - self.clock()) > 0:
            self.sleep(wait)
        self.free[place] = self.clock() + self.span


@dataclass(frozen=True)
class Calls:
    """How the calls of a job are made: attempts, and the rate that its tasks share; None is no limit."""

    attempts: int = 3
    per_minute: int | None = None
    tasks: int = 1

    def begin(self, sleep: Callable[[float], None] = time.sleep) -> Callable[[Callable[[], object]], object]:
        """A function for one task that makes a call, with retries, each within the task's share of the rate."""
        share = RateShare(self.per_minute, self.tasks) if self.per_minute else None

        def once(call):
            if share:
                share.acquire()
            return call()

        return lambda call: with_retries(lambda: once(call), self.attempts, sleep)


MODALITIES = ("text", "multimodal", "embedding")
EFFORTS = ("low", "medium", "high")
DETAILS = ("auto", "low", "high")


@dataclass(frozen=True)
class TaskSettings:
    """How one kind of task calls its model."""

    task_name: str
    model: str
    api_key: str = ""
    base_url: str = ""
    prompt: str = ""
    modality: str = "text"
    supports_thinking: bool = False
    thinking_enabled: bool = False
    reasoning_effort: str | None = None
    image_detail: str = "high"
    rpm: int = 60
    max_concurrency: int = 4
    timeout_seconds: float = 60.0
    max_retries: int = 3
    encoding_format: str = "float"
    embedding_dimensions: int | None = None

    def __post_init__(self):
        if not self.model.strip():
            raise ValueError(f"provider.model is required for task '{self.task_name}'")
        for name, allowed in (("modality", MODALITIES), ("image_detail", DETAILS), ("reasoning_effort", (None, *EFFORTS))):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of: {', '.join(x for x in allowed if x)}")
        for name in ("rpm", "max_concurrency", "timeout_seconds", "max_retries", "embedding_dimensions"):
            if (v := getattr(self, name)) is not None and v <= 0:
                raise ValueError(f"{name} must be greater than 0")
        if self.thinking_enabled and not self.supports_thinking:
            raise ValueError(f"task '{self.task_name}' enables thinking, which its provider does not support")

    def calls(self, tasks: int | None = None) -> Calls:
        """Its attempts and rate; tasks: how many share the rate (its concurrency)."""
        return Calls(self.max_retries, self.rpm, tasks or self.max_concurrency)


def _mapping(value, what: str) -> dict:
    if value in (None, ""):
        return {}
    if not isinstance(value, dict):
        raise ValueError(f"{what} must be a mapping")
    return value


def _flag(value, what: str) -> bool:
    if value in (None, ""):
        return False
    if not isinstance(value, bool):
        raise ValueError(f"{what} must be a boolean")
    return value


def settings_of(config: dict, task: str, api_key: str = "") -> TaskSettings:
    """Settings of a task: provider, request and rate limit of the profile it names under llm.profiles, or, where there are no
    profiles, its own; the prompt is its own. What is not given has the default."""
    own = _mapping(config.get(task), f"top-level '{task}'")
    profiles = _mapping(_mapping(config.get("llm"), "top-level 'llm'").get("profiles"), "llm.profiles")
    source = own
    if profiles:
        name = own.get("llm_profile")
        if not isinstance(name, str) or not name.strip():
            raise ValueError(f"task '{task}' must set llm_profile when llm.profiles is configured")
        if name.strip() not in profiles:
            raise ValueError(f"task '{task}' references unknown llm_profile '{name.strip()}'")
        source = _mapping(profiles[name.strip()], f"llm.profiles.{name.strip()}")
    provider, request, rate = (_mapping(source.get(k), k) for k in ("provider", "request", "rate_limit"))
    prompts, thinking = _mapping(own.get("prompts"), "prompts"), _mapping(request.get("thinking"), "request.thinking")
    enabled = _flag(thinking.get("enabled"), "request.thinking.enabled")
    effort = thinking.get("effort")
    if effort not in (None, "") and not isinstance(effort, str):
        raise ValueError("request.thinking.effort must be a string")
    said = {
        "model": provider.get("model"), "base_url": provider.get("base_url"), "image_detail": request.get("image_detail"), "encoding_format": request.get("encoding_format"),
        "modality": provider.get("modality") or ("embedding" if task.endswith("_embed") else "multimodal" if task == "ocr" else "text"),
        "prompt": prompts.get(own.get("prompt_key") or "default", prompts.get("default")), "reasoning_effort": effort or ("medium" if enabled else None),
    }
    numbers = {
        "rpm": (rate.get("rpm"), int), "max_concurrency": (rate.get("max_concurrency"), int), "timeout_seconds": (request.get("timeout_seconds"), float),
        "max_retries": (request.get("max_retries"), int), "embedding_dimensions": (request.get("dimensions"), int),
    }
    given = {k: v.strip() for k, v in said.items() if isinstance(v, str) and v.strip()}
    given |= {k: given[k].lower() for k in ("modality", "image_detail", "reasoning_effort") if k in given}
    given |= {k: kind(v) for k, (v, kind) in numbers.items() if v not in (None, "")}
    return TaskSettings(task, api_key=api_key, supports_thinking=_flag(provider.get("supports_thinking"), "provider.supports_thinking"), thinking_enabled=enabled, **{"model": "", **given})


@dataclass(frozen=True)
class Message:
    """content: text, or parts ("text", text) and ("image", data URL)."""

    role: str
    content: str | list[tuple[str, str]]


def chat_request(settings: TaskSettings, messages: list[Message]) -> dict:
    """What is sent to a chat model: messages in the usual wire form, effort if the task thinks. Images need a multimodal
    task; parts of other kinds raise."""
    out = []
    for m in messages:
        if isinstance(m.content, str):
            out.append({"role": m.role, "content": m.content})
            continue
        parts = []
        for kind, value in m.content:
            if kind not in ("text", "image"):
                raise ValueError(f"unsupported content: {kind}")
            if kind == "image" and settings.modality != "multimodal":
                raise ValueError(f"task '{settings.task_name}' is for text only and cannot take images")
            parts.append({"type": "text", "text": value} if kind == "text" else {"type": "image_url", "image_url": {"url": value, "detail": settings.image_detail}})
        out.append({"role": m.role, "content": parts})
    effort = {"reasoning_effort": settings.reasoning_effort} if settings.thinking_enabled and settings.reasoning_effort else {}
    return {"model": settings.model, "messages": out, **effort}


def embedding_request(settings: TaskSettings, texts: list[str]) -> dict:
    if settings.modality != "embedding":
        raise ValueError(f"task '{settings.task_name}' is configured with modality={settings.modality}")
    size = {"dimensions": settings.embedding_dimensions} if settings.embedding_dimensions else {}
    return {"model": settings.model, "input": texts, "encoding_format": settings.encoding_format, **size}


class RuleExtractor:
    """Finds what a few sentence patterns say; a deterministic stand-in for a model."""

    #: Patterns of sentences, by the relation each states.
    PATTERNS = (
        (r"(?P<h>[^，。；、,.\s]{2,30}?)(?:包含|由)(?P<t>[^，。；、,.\s]{2,30}?)(?:组成|以及|和|[，。；])", "contains"),
        (r"(?P<h>[A-Z][^，。,.\n]{1,40}?) (?:contains|consists of|includes) (?P<t>[^，。,.\n]{2,40}?)(?: and |[,.])", "contains"),
        (r"(?P<h>[^，。；、,.\s]{2,30}?)(?:在[^，。]{2,12}上)?依赖(?P<t>[^，。；、,.\s]{2,30}?)(?:来|[，。；])", "depends_on"),
        (r"(?P<h>[A-Z][^，。,.\n]{1,40}?) (?:depends on|relies on) (?P<t>[^，。,.\n]{2,40}?)(?: for | whenever |[,.])", "depends_on"),
        (r"把(?P<h>[^，。；、,.\s]{2,30}?)与(?P<t>[^，。；、,.\s]{2,30}?)(?:作了对比|混为一谈)", "compared_with"),
        (r"比较(?P<h>[^，。；、,.\s]{2,30}?)与(?P<t>[^，。；、,.\s]{2,30}?)[，。；]", "compared_with"),
        (r"(?i:contrasts|compare) (?P<h>[^，。,.\n]{2,40}?) with (?P<t>[^，。,.\n]{2,40}?)(?: and explain|[,.])", "compared_with"),
        (r"把(?P<h>[^，。；、,.\s]{2,30}?)(?:用于|应用于)(?P<t>[^，。；、,.\s]{2,30}?)[，。；]", "applied_to"),
        (r"(?P<h>[A-Z][^，。,.\n]{1,40}?) is (?:applied to|used for) (?P<t>[^，。,.\n]{2,40}?)(?: in |[,.])", "applied_to"),
    )

    def extract(self, text: str, prompt: str = "") -> str:
        triples, names = [], []
        for pattern, relation in self.PATTERNS:
            for m in re.finditer(pattern, text):
                h, t = m.group("h").strip(), m.group("t").strip()
                triples.append({"head": h, "relation": relation, "tail": t, "evidence": m.group().strip()})
                names += [h, t]
        entities = [{"name": n, "type": self.kind(n), "description": ""} for n in dict.fromkeys(names)]
        return json.dumps({"entities": entities, "triples": triples}, ensure_ascii=False)

    @staticmethod
    def kind(name: str) -> str:
        if name.endswith(("协议", "Protocol", "protocol")):
            return ENTITY_TYPES[0]
        if name.endswith(("时延", "开销", "比率", "抖动", "Latency", "Overhead", "Ratio", "Jitter")):
            return ENTITY_TYPES[3]
        return ENTITY_TYPES[1]


class DescribedJudge:
    """Merges a pair of which either side has a description, under the left name, and cites the first ones; a deterministic
    stand-in for a model."""

    def judge(self, question: str) -> str:
        q = json.loads(question)
        both = [q[s]["descriptions"] for s in ("left", "right")]
        if not all(both):
            return json.dumps({"decision": "unsure"})
        return json.dumps({"decision": "merge", "canonical_name": q["left"]["name"], "supporting_evidence_ids": [d[0]["id"] for d in both], "reason_code": "DESCRIBED"}, ensure_ascii=False)


class Scripted:
    """Answers from a list in turn; an exception in it is raised."""

    def __init__(self, answers: list):
        self.answers = list(answers)

    def _next(self, *_):
        answer = self.answers.pop(0)
        if isinstance(answer, BaseException):
            raise answer
        return answer

    extract = judge = read = embed = _next
