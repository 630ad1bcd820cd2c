"""Memory of workers that turn from one module's work to another's."""

from __future__ import annotations

from feedlake.llm import arrow


def test_a_worker_gives_back_what_was_freed_when_its_work_changes(monkeypatch):
    given_back = []

    class Pool:
        def __init__(self, name):
            self.release_unused = lambda: given_back.append(name)

    monkeypatch.setattr(arrow.pa, "default_memory_pool", lambda: Pool("arrow"))
    monkeypatch.setattr(arrow.pa, "system_memory_pool", lambda: Pool("system"))
    monkeypatch.setattr(arrow, "_last_user", [])
    monkeypatch.setattr(arrow, "_remembered", [])
    held = arrow.remembered("one")
    arrow.turn_to("feedlake.llm.one")
    held["a"] = 1
    arrow.turn_to("feedlake.llm.one")
    assert held and not given_back
    arrow.turn_to("feedlake.llm.other")
    assert not held and given_back == ["arrow", "system"]
