"""Calls of external models: clients behind a protocol, retries, prompts again after bad answers, chunks split when they fail, merges and reviews."""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import parsed
from ..functions.text import clean_text
from ..session import ship
from .chunks import split_again

#: Parts of messages (upper-case) of errors that are worth another try, of those of set-up, and of requests that never work.
RETRYABLE = ("429", "RESOURCE_EXHAUSTED", "RATE LIMIT", "500", "INTERNAL", "502", "503", "UNAVAILABLE", "HIGH DEMAND", "OVERLOADED", "TRY AGAIN LATER", "504", "DEADLINE_EXCEEDED", "TIMEOUT", "TIMED OUT", "TEMPORAR", "CONNECTION")
CONFIGURATION = ("API KEY", "API_KEY", "UNAUTHENTICATED", "PERMISSION_DENIED", "UNAUTHORIZED", "401", "403", "PIP INSTALL", "NO API KEY", "MISSING API KEY")
REQUEST = ("HTTP 400", "HTTP 404", "MAXIMUM CONTEXT LENGTH", "INPUT_TOKENS", "DOES NOT EXIST", "NOTFOUNDERROR")
ALIASES = {"anthropic": "claude", "open-ai": "openai", "google": "gemini", "local": "gemma"}
PROVIDERS = ("gemini", "openai", "claude", "gemma")
GEMINI = ("3.1-pro-preview", "3.1-pro", "2.5-pro", "2.5-flash", "2.0-flash", "1.5-pro", "1.5-flash")
GEMMA = {"latest": "gemma4:31b", "highest": "gemma4:31b", "max": "gemma4:31b", "e2b": "gemma4:e2b", "e4b": "gemma4:e4b", "12b": "gemma4:12b", "26b": "gemma4:26b", "31b": "gemma4:31b", "27b": "gemma3:27b"}


class ModelClient(Protocol):
    def complete(self, prompt: str) -> str: ...


class Truncated(RuntimeError):
    """An answer that ended at its limit: shorter chunks help, asking again doesn't."""


def is_retryable(error: Exception) -> bool:
    return any(m in str(error).upper() for m in RETRYABLE)


def is_configuration(error: Exception) -> bool:
    return any(m in str(error).upper() for m in CONFIGURATION)


def is_bad_request(error: Exception) -> bool:
    return any(m in str(error).upper() for m in REQUEST)


def provider_name(name: str) -> str:
    """A provider's name without its aliases; another one is an error."""
    name = ALIASES.get(name.strip().lower(), name.strip().lower())
    if name not in PROVIDERS:
        raise ValueError(f"no such provider: {name}; there are {', '.join(PROVIDERS)}")
    return name


def providers(names: str) -> list[str]:
    """The providers of a list with commas, each once; all, multi and * stand for every one."""
    if names.strip().lower() in ("*", "multi", "all"):
        return list(PROVIDERS)
    return list(dict.fromkeys(provider_name(n) for n in names.split(",")))


def provider_of(name: Column) -> Column:
    """provider_name as a Column; null for others."""
    n = F.lower(clean_text(name))
    out = n
    for k, v in ALIASES.items():
        out = F.when(n == k, v).otherwise(out)
    return F.when(out.isin(*PROVIDERS), out)


def model_of(provider: Column, model: Column) -> Column:
    """A model's full name: of short ones, as the provider calls them."""
    m = clean_text(model)
    bare = F.when(provider.isin("gemini", "gemma") & m.startswith("models/"), F.substring(m, F.lit(8), F.char_length(m))).otherwise(m)
    out = F.when((provider == "gemini") & bare.isin(*GEMINI), F.concat(F.lit("gemini-"), bare)).otherwise(bare)
    for k, v in GEMMA.items():
        out = F.when((provider == "gemma") & (bare == k), v).otherwise(out)
    return out


def model_list(primary: Column, fallbacks: Column) -> Column:
    """The primary model and the fallbacks of a list with commas, each once, in order."""
    names = F.transform(F.concat(F.array(primary), F.split(F.coalesce(fallbacks, F.lit("")), ",")), clean_text)
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def with_retry(call: Callable[[], str], tries: int = 5, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """call, again after growing pauses (at most 60 s) as long as its errors are worth it."""
    for k in range(max(1, tries)):
        try:
            return call()
        except Exception as e:
            if k + 1 >= tries or is_configuration(e) or is_bad_request(e) or isinstance(e, Truncated) or not is_retryable(e):
                raise
            sleep(min(60.0, base * 2**k) + random.uniform(0, min(1.0, base)))
    raise AssertionError


@dataclass
class ChatClient:
    """A server that speaks the common chat-completions protocol: one JSON object asked for, the answer's text returned."""

    base_url: str
    model: str
    api_key: str = ""
    timeout: int = 600
    temperature: float = 0.0
    max_tokens: int = 16_384
    system: str = "Answer with one JSON object and nothing else."
    schema: dict | None = None
    #: Tokens used so far, as the server counts them.
    usage: dict[str, int] = field(default_factory=lambda: {"prompt_tokens": 0, "completion_tokens": 0, "total_tokens": 0})

    def complete(self, prompt: str) -> str:
        form = {"type": "json_schema", "json_schema": {"name": "answer", "schema": self.schema}} if self.schema else {"type": "json_object"}
        body = {"model": self.model, "messages": [{"role": "system", "content": self.system}, {"role": "user", "content": prompt}], "temperature": max(0.0, self.temperature), "max_tokens": max(1, self.max_tokens), "response_format": form}
        headers = {"Content-Type": "application/json", "Accept": "application/json"} | ({"Authorization": f"Bearer {self.api_key.strip()}"} if self.api_key.strip() else {})
        url = self.base_url.rstrip("/") + "/chat/completions"
        try:
            with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), headers, method="POST"), timeout=max(1, self.timeout)) as r:
                text = r.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"HTTP {e.code} {e.reason} of {url}: {e.read().decode('utf-8', 'replace')[:1000]}") from e
        except urllib.error.URLError as e:
            raise RuntimeError(f"no connection to {url}: {e}") from e
        return self.read(text)

    def read(self, text: str) -> str:
        """The answer in a server's reply."""
        try:
            data = json.loads(text)
            first = data["choices"][0]
        except (ValueError, KeyError, IndexError, TypeError) as e:
            raise RuntimeError(f"a reply without choices: {text[:1000]}") from e
        for k, v in (data.get("usage") or {}).items():
            if k in self.usage:
                self.usage[k] += int(v or 0)
        if first.get("finish_reason") == "length":
            raise Truncated(f"the answer reached {self.max_tokens} tokens before it was complete")
        content = (first.get("message") or {}).get("content", first.get("text"))
        return "\n".join(p.get("text", "") if isinstance(p, dict) else str(p) for p in content) if isinstance(content, list) else str(content or "")


def ask_json(client: ModelClient, prompt: str, tries: int = 3, base: float = 0.0) -> tuple[dict, str]:
    """(object, raw text) of a model's answer; after one that is no JSON object it is told so, and asked again."""
    ask, raw = prompt, ""
    for k in range(max(1, tries)):
        raw = with_retry(lambda ask=ask: client.complete(ask), tries, base)
        if (found := parsed(raw)) is not None:
            return found, raw
        ask = f"{prompt}\n\nThe last answer was no valid JSON object. It began with:\n{raw[:500]}\nAnswer with the object alone."
    raise ValueError(f"no JSON object after {tries} answers; the last began with {raw[:200]!r}")


def ask_any(clients: list[ModelClient], prompt: str, tries: int = 3, base: float = 0.0) -> tuple[dict, str, int]:
    """ask_json of the first client that answers: (object, raw text, which one). A truncated answer ends it: no other model is asked."""
    last: Exception | None = None
    for k, c in enumerate(clients):
        try:
            return *ask_json(c, prompt, tries, base), k
        except Truncated:
            raise
        except Exception as e:
            last = e
    raise last or ValueError("no client")


ANSWERS = "doc_id long, chunk string, start_page long, end_page long, answer string, raw string, error string"


def ask_chunks(chunks: DataFrame, clients: Callable[[], list[ModelClient]], *, prompt: str = "{text}", tries: int = 3, base: float = 0.0, depth: int = 4, most: int = 10_000, json_depth: int = 6, json_most: int = 1_500) -> DataFrame:
    """ANSWERS of chunks (doc_id, chunk, start_page, end_page, text) put into prompt, by the first of the clients that answers.

    A chunk without an answer is split by its pages into halves, while it is longer than `most` characters and less than `depth` splits
    deep, or json_most and json_depth if answers came that were no JSON; its parts are asked by themselves. What still fails keeps its error.
    """
    ship(chunks.sparkSession)

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = clients()
        for pdf in batches:
            out = []
            todo = [(d, str(c), a, b, t or "", 0) for d, c, a, b, t in zip(pdf["doc_id"], pdf["chunk"], pdf["start_page"], pdf["end_page"], pdf["text"], strict=True)][::-1]
            while todo:
                d, c, a, b, t, k = todo.pop()
                try:
                    found, raw, _ = ask_any(asked, prompt.replace("{text}", t), tries, base)
                    out.append((d, c, a, b, json.dumps(found, ensure_ascii=False), raw, None))
                except Exception as e:
                    deepest, least = (json_depth, json_most) if isinstance(e, (ValueError, Truncated)) else (depth, most)
                    parts = split_again(t, max(least, len(t) // 2), a, b, least) if k < deepest and len(t) > least else []
                    if len(parts) > 1:
                        todo += [(d, f"{c}.{n}", x, y, s, k + 1) for n, (x, y, s) in reversed(list(enumerate(parts, 1)))]
                    else:
                        out.append((d, c, a, b, None, None, str(e)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in ANSWERS.split(", ")])

    return chunks.select("doc_id", F.col("chunk").cast("string").alias("chunk"), "start_page", "end_page", "text").mapInPandas(answers, ANSWERS)


def ask(prompts: DataFrame, client: Callable[[], ModelClient], *, tries: int = 3, depth: int = 4, least: int = 1_500) -> DataFrame:
    """(doc_id, chunk, answer, error) of prompts (doc_id, chunk, text): ask_chunks with one client and answers as they came."""
    none = F.lit(None).cast("long")
    d = prompts.select("doc_id", "chunk", none.alias("start_page"), none.alias("end_page"), "text")
    found = ask_chunks(d, lambda: [client()], tries=tries, depth=depth, most=least, json_depth=depth, json_most=least)
    return found.select("doc_id", "chunk", F.col("raw").alias("answer"), "error")


def fan_out(docs: DataFrame, names: str) -> DataFrame:
    """docs once for each provider of a list with commas."""
    return docs.withColumn("provider", F.explode(F.array(*[F.lit(p) for p in providers(names)])))


def chapters_of(answers: DataFrame) -> DataFrame:
    """(doc_id, chunk, start_page, end_page, title, fallback, chapters) of answers that are tables of contents, as toc.promote and its like take them."""
    o = F.from_json("answer", "title string, chapters array<map<string,string>>")
    d = answers.where("answer is not null").withColumn("_o", o)
    return d.select("doc_id", "chunk", "start_page", "end_page", F.col("_o.title").alias("title"), F.lit("").alias("fallback"), F.coalesce("_o.chapters", F.array().cast("array<map<string,string>>")).alias("chapters"))


def merge_by_model(batches_: DataFrame, clients: Callable[[], list[ModelClient]], *, prompt: str = "{text}", tries: int = 3) -> DataFrame:
    """Tables of batches of partial ones (doc_id, batch, json: an array of {chunk, start_page, end_page, toc}) as a model merges them: doc_id, batch, answer, error."""
    d = batches_.select("doc_id", F.col("batch").alias("chunk"), F.lit(1).alias("start_page"), F.lit(1).alias("end_page"), F.col("json").alias("text"))
    found = ask_chunks(d, clients, prompt=prompt, tries=tries, depth=0, json_depth=0)
    return found.select("doc_id", F.col("chunk").cast("int").alias("batch"), "answer", "error")


def merged_or_local(answers: DataFrame, partials: DataFrame, max_depth: int = 6) -> DataFrame:
    """Tables that a model merged (answers of merge_by_model, batches in order), as rows; documents that it failed, or whose tail it lost, are merged by layout.

    partials: entries with chunk and layout columns. The result has how: model or local.
    """
    from .attach import merge_locally
    from .review import truncated
    from .toc import answer_rows, promote

    rows = chapters_of(answers.withColumns({"chunk": F.col("batch").cast("string"), "start_page": F.lit(1), "end_page": F.lit(1)})).withColumn("_at", F.col("chunk").cast("int"))
    texts = F.array_sort(F.collect_list(F.struct("_at", F.to_json("chapters").alias("j"))))  # maps have no order, texts do
    many = F.flatten(F.transform(texts, lambda v: F.from_json(v["j"], "array<map<string,string>>")))
    whole = rows.groupBy("doc_id").agg(F.lit("").alias("title"), F.lit("").alias("fallback"), many.alias("chapters"))
    failed = answers.groupBy("doc_id").agg(F.bool_or(F.col("answer").isNull()).alias("_failed"))
    by_model = answer_rows(promote(whole), max_depth).select("doc_id", "pos", "level", "chapter", "page")
    lost = truncated(by_model, partials)
    local = partials.select("doc_id").distinct().join(failed, "doc_id", "left").join(lost, "doc_id", "left").join(by_model.select("doc_id").distinct().withColumn("_has", F.lit(True)), "doc_id", "left")
    local = local.where("coalesce(_failed, true) or coalesce(truncated, false) or _has is null").select("doc_id")
    rest = merge_locally(partials.join(local, "doc_id", "left_semi"), max_depth).select("doc_id", "pos", "level", "chapter", "page")
    return by_model.join(local, "doc_id", "left_anti").withColumn("how", F.lit("model")).unionByName(rest.withColumn("how", F.lit("local")))


def reviewed(toc: DataFrame, answers: DataFrame, max_depth: int = 6) -> DataFrame:
    """The table after a model's review (answers of ask_chunks on a prompt per document): what it answered, with the layout and reasons that it left out; where it failed, the table as it was."""
    from .attach import restore_from_source
    from .toc import answer_rows

    a = chapters_of(answers).where(F.size("chapters") > 0)
    new = answer_rows(a, max_depth).withColumn("merge_order", F.lit(None).cast("int"))
    new = restore_from_source(new.select(*toc.columns), toc)
    return new.unionByName(toc.join(a.select("doc_id").distinct(), "doc_id", "left_anti"))
