"""A text generator behind an HTTP chat-completions endpoint."""

from __future__ import annotations

import contextlib
import http.client
import json
import urllib.parse
from dataclasses import dataclass

from ..config import SYSTEM_PROMPT, Config


@dataclass(frozen=True)
class ChatRephraser:
    """Posts each request to ``{endpoint}/chat/completions``; anything but a text in the answer is an error."""

    model: str
    api_key: str
    temperature: float
    top_p: float
    max_tokens: int
    repetition_penalty: float
    #: Seconds to connect, to send a request and to wait for its answer.
    connect: float = 60.0
    send: float = 300.0
    read: float = 600.0
    system: str = SYSTEM_PROMPT

    @classmethod
    def of(cls, config: Config) -> ChatRephraser:
        own = config.generator
        return cls(own.model, own.key, own.temperature, own.top_p, own.most_tokens, own.repetition_penalty)

    def body(self, request: str) -> dict:
        return {
            "model": self.model,
            "messages": [{"role": "system", "content": self.system}, {"role": "user", "content": request}],
            "temperature": self.temperature, "top_p": self.top_p, "max_tokens": self.max_tokens, "repetition_penalty": self.repetition_penalty,
            "chat_template_kwargs": {"enable_thinking": False},
        }

    def __call__(self, endpoint: str, prompt: str, request: str) -> str:
        at = urllib.parse.urlsplit(f"{endpoint}/chat/completions")
        kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
        with contextlib.closing(kind(at.netloc, timeout=self.connect)) as link:
            link.connect()
            link.sock.settimeout(self.send)
            link.request("POST", at.path, json.dumps(self.body(request)).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"})
            link.sock.settimeout(self.read)
            answer = link.getresponse()
            if answer.status != 200:
                raise OSError(f"{answer.status} {answer.reason}")
            text = json.load(answer)["choices"][0]["message"]["content"]
        if not isinstance(text, str):
            raise ValueError("the answer has no text")
        return text
