"""A chat model, a judge and an encoder whose answers follow from the prompt, for queries over the generation run."""

from __future__ import annotations

import json
import re

from tessera.operators.chat import ApiError
from tessera.schema import QUALITY_WEIGHTS

#: What the model is asked: the sample's id, the attempt and the number of turns.
TEMPLATE, JUDGE_TEMPLATE = "{id} attempt={attempt} turns={turn_count}", "{scenario_json}"
#: Of kinds 0 to 10; the others are good records.
API_ERROR, NO_JSON, PERSONAL, COPY, SHALLOW, UNEXPECTED = range(6)
KINDS = 11


def kind(sample: int, attempt: int) -> int:
    return (7 * sample + 3 * attempt) % KINDS


def client():
    def call(prompt: str, **options) -> dict:
        sample, attempt, turns = map(int, re.fullmatch(r"scenario-(\d+)-\w+ attempt=(\d+) turns=(\d+)", prompt).groups())
        k = kind(sample, attempt)
        if k == API_ERROR:
            raise ApiError("connection reset")
        if k == UNEXPECTED:
            raise TypeError("no such model")
        if k == NO_JSON:
            return {"text": "I would rather not { say"}
        topic = f"topic {0 if k == COPY else sample}" + (" mail me at a@b.org" if k == PERSONAL else "") + (" shallow" if k == SHALLOW else "")
        messages = [{"role": ("user", "assistant")[i % 2], "content": f"{topic}, turn {i}"} for i in range(turns)]
        reply = {"messages": messages, "tools": ["git", "hammer"], "language": "go", "metadata": {"rating": sample}}
        return {"text": "```json\n" + json.dumps(reply) + "\n```", "usage": {"prompt_tokens": 5, "completion_tokens": 10, "total_tokens": 15}}

    return call


def judge():
    def call(prompt: str, **options) -> dict:
        score = 2 if "shallow" in prompt else 9
        return {"text": json.dumps({"dimensions": [{"name": k, "score": score, "reasoning": "as it reads"} for k in QUALITY_WEIGHTS]})}

    return call


#: Bits of a topic's number, and a label of each with at least two bits set; no two labels are the same.
BITS = 33
LABELS = [p for p in range(64) if p.bit_count() > 1][:BITS]


def encoder():
    """Vectors of 40 numbers, 1 or -1: a topic's bits, six checks and the parity, as in an extended Hamming code.

    Codes of two topics below 2^33 differ in four places at least, so their cosine is 0.8 at most, however many there are.
    """

    def code(n: int) -> list[float]:
        if not 0 <= n < 1 << BITS:
            raise ValueError(f"no topic {n}")
        bits = [n >> j & 1 for j in range(BITS)]
        check = 0
        for bit, label in zip(bits, LABELS, strict=True):
            check ^= bit * label
        bits += [check >> j & 1 for j in range(6)]
        return [1.0 - 2 * b for b in (*bits, sum(bits) % 2)]

    def encode(texts: list[str]) -> list[list[float]]:
        return [code(int(re.search(r"topic (\d+)", t)[1])) for t in texts]

    return encode
