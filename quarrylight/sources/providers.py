"""What the engine needs from outside: fetching, embeddings, languages, translation.

Each is a small protocol with a deterministic implementation for tests and offline runs. Objects are sent
to executors with the task that uses them.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np

from ..catalogue import TRANSLATION_PROMPT


@dataclass
class Response:
    url: str
    status: int = 200
    content_type: str = "text/html"
    text: str = ""


class FetchError(Exception):
    """A request that gave no response; kind: Timeout, ConnectError, TooManyRedirects or HTTPError."""

    def __init__(self, kind: str):
        super().__init__(kind)
        self.kind = kind


class Fetcher(Protocol):
    def get(self, url: str) -> Response: ...


class Embedder(Protocol):
    def encode(self, texts: list[str]) -> np.ndarray: ...


class LanguageDetector(Protocol):
    def detect(self, text: str) -> tuple[str, str]: ...


class Translator(Protocol):
    name: str

    def translate(self, text: str, code: str, language: str) -> str: ...


@dataclass
class ReplayFetcher:
    """Answers from a table of pages; unknown addresses are 404, or fail to connect."""

    pages: dict[str, Response] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    unknown_status: int | None = 404

    def get(self, url: str) -> Response:
        if url in self.errors:
            raise FetchError(self.errors[url])
        if url in self.pages:
            return self.pages[url]
        if self.unknown_status is None:
            raise FetchError("ConnectError")
        return Response(url, self.unknown_status)


@dataclass
class HttpFetcher:
    """The network, with redirects followed."""

    timeout: float = 15.0
    agent: str = "Mozilla/5.0 (compatible; research crawler)"
    body: bytes | None = None

    def get(self, url: str) -> Response:
        import urllib.error
        import urllib.request

        try:
            with urllib.request.urlopen(urllib.request.Request(url, self.body, {"User-Agent": self.agent}), timeout=self.timeout) as r:
                return Response(r.geturl(), r.status, r.headers.get("Content-Type", "").lower(), r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"))
        except urllib.error.HTTPError as e:
            return Response(url, e.code, e.headers.get("Content-Type", "").lower(), "")
        except TimeoutError:
            raise FetchError("Timeout") from None
        except (urllib.error.URLError, OSError) as e:
            raise FetchError("Timeout" if isinstance(getattr(e, "reason", None), TimeoutError) else "ConnectError") from None


@dataclass
class HashEmbedder:
    """Words and letter triples hashed into a unit vector: deterministic, and similar for similar texts."""

    size: int = 256

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size))
        for i, text in enumerate(texts):
            for word in re.findall(r"\w+", text.lower()):
                for piece in (word, *(word[k : k + 3] for k in range(len(word) - 2))):
                    h = int.from_bytes(hashlib.blake2b(piece.encode(), digest_size=8).digest(), "little")
                    out[i, h % self.size] += 1 if h >> 63 else -1
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length == 0, 1, length)


_MODELS: dict[tuple, tuple] = {}


@dataclass
class OnnxEmbedder:
    """A sentence model as an ONNX file with its tokenizer.json: mean of the token vectors, scaled to length one.

    Both files are read once in each worker, so their paths must lead to them on every executor. Texts are cut
    at max_tokens, as such models are.
    """

    model: str
    tokenizer: str
    max_tokens: int = 256
    batch: int = 32

    def _loaded(self) -> tuple:
        key = (self.model, self.tokenizer)
        if key not in _MODELS:
            import onnxruntime
            from tokenizers import Tokenizer

            _MODELS[key] = onnxruntime.InferenceSession(self.model), Tokenizer.from_file(self.tokenizer)
        return _MODELS[key]

    def encode(self, texts: list[str]) -> np.ndarray:
        session, tokenizer = self._loaded()
        tokenizer.enable_truncation(self.max_tokens)
        tokenizer.enable_padding()
        wanted, out = {i.name for i in session.get_inputs()}, []
        for at in range(0, len(texts), self.batch):
            coded = tokenizer.encode_batch(list(texts[at : at + self.batch]))
            given = {"input_ids": [c.ids for c in coded], "attention_mask": [c.attention_mask for c in coded], "token_type_ids": [c.type_ids for c in coded]}
            given = {name: np.array(rows, dtype=np.int64) for name, rows in given.items()}
            tokens = session.run(None, {name: rows for name, rows in given.items() if name in wanted})[0]
            out.append(mean_vectors(tokens, given["attention_mask"]))
        return np.concatenate(out) if out else np.zeros((0, 0))


def mean_vectors(tokens: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean over the tokens that the mask keeps, scaled to length one; zero where it keeps none."""
    kept = mask[:, :, None].astype(np.float64)
    mean = (tokens * kept).sum(1) / np.maximum(kept.sum(1), 1)
    length = np.linalg.norm(mean, axis=1, keepdims=True)
    return mean / np.where(length == 0, 1, length)


#: Frequent words by language. Fixed values.
STOPWORDS = {
    "en": ("English", "the and of to in is that for with are this on we our"),
    "de": ("German", "der die und das ist nicht ein eine mit von den auf für wir"),
    "fr": ("French", "le la les de des et est une dans pour que nous pas sur"),
    "es": ("Spanish", "el la los las de que y en un una por para con nuestra"),
    "pt": ("Portuguese", "o a os as de que e em um uma para com nossa não"),
    "tr": ("Turkish", "ve bir bu için ile olarak de da en çok daha biz"),
}

_COMMON = {code: frozenset(common.split()) for code, (_, common) in STOPWORDS.items()}


class StopwordDetector:
    """The language whose frequent words are most frequent."""

    def detect(self, text: str) -> tuple[str, str]:
        words = Counter(re.findall(r"\w+", text.lower()))
        found = {code: sum(words.get(w, 0) for w in common) for code, common in _COMMON.items()}
        best = max(found, key=found.get)
        if not found[best]:
            raise ValueError("no language found")
        return best, STOPWORDS[best][0]


class MarkingTranslator:
    """Stands for a translator: the text with its language in front."""

    name = "marking"

    def translate(self, text: str, code: str, language: str) -> str:
        return f"[{code}] {text}"


@dataclass
class ChatTranslator:
    """A chat model behind a local HTTP service."""

    base: str = "http://localhost:11434"
    model: str = "translategemma:4b"
    timeout: float = 120.0

    @property
    def name(self) -> str:
        return f"ollama:{self.model}"

    def healthy(self) -> bool:
        try:
            return HttpFetcher(self.timeout).get(f"{self.base}/api/tags").status < 400
        except FetchError:
            return False

    def translate(self, text: str, code: str, language: str) -> str:
        import json

        prompt = TRANSLATION_PROMPT % (language, code, text)
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "stream": False, "options": {"temperature": 0}}
        answer = HttpFetcher(self.timeout, body=json.dumps(body).encode()).get(f"{self.base}/api/chat")
        if answer.status >= 400:
            raise ValueError(f"status {answer.status}")
        return json.loads(answer.text)["message"]["content"]
