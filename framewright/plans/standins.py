"""Engines for queries that show what a stage does when an engine fails."""

from __future__ import annotations

from framewright.operators.engines import ModelEngine, OcrEngine, echo_model

BUSY = "busy"


def moody_model() -> ModelEngine:
    """Echoes, but raises for texts with the word ``busy`` unless the prompt says ``again``."""
    echo = echo_model()

    def ask(prompt: str, text: str) -> tuple[str, int, int]:
        if BUSY in text.split() and "again" not in prompt:
            raise RuntimeError("the model is busy")
        return echo(prompt, text)

    return ask


def marked_ocr() -> OcrEngine:
    """The first byte tells what happens, so that a text may begin with anything: ``=`` the rest is the text, ``!`` it is raised; without bytes there is no text."""

    def read(content: bytes) -> str | None:
        mark, rest = content[:1], content[1:].decode()
        if mark == b"!":
            raise ValueError(rest)
        return rest if mark == b"=" else None

    return read
