"""A small plug-in extractor for the model-call stage.

``LineFormatExtractor`` answers like a model would (``{"events": [...]}`` JSON), but
reads the rigid line formats of the listing profiles. It stands in for a model
client in tests and in the plug-in query, and shows the contract: a picklable
callable, one chunk in, one JSON text out, exceptions allowed (the chunk then
yields nothing).
"""

from __future__ import annotations

import hashlib
import json
import re

from calforge.operators import extract as X


class LineFormatExtractor:
    def __init__(self, default_year: int = X.DEFAULT_YEAR):
        self.default_year = default_year
        self._card = re.compile(X.CARD_LINE_RE.replace(r"\A", "^").replace(r"\z", r"\Z"))
        self._iso = re.compile(X.ISO_RE)
        self._dmy = re.compile(X.DMY_RE)
        self._hm = re.compile(X.HM_RE)

    def _date(self, text: str) -> str:
        m = self._iso.search(text)
        if m:
            return f"{m.group(2)}-{m.group(3)}-{m.group(4)}"
        m = self._dmy.search(text)
        if m:
            return f"{m.group(4) or self.default_year}-{int(m.group(3)):02d}-{int(m.group(2)):02d}"
        return text

    def _time(self, text: str):
        m = self._hm.search(text)
        return f"{int(m.group(2)):02d}:{m.group(3)}" if m else None

    def __call__(self, chunk: str) -> str:
        lines = (chunk or "").split("\n")
        events = []
        for i, line in enumerate(lines):
            if not line.startswith("Event: "):
                continue
            m = self._card.match(line)
            nxt = lines[i + 1:i + 4] + [None] * 3
            if m:
                title, date_text, place = m.group(1), m.group(2), m.group(3)
                time_text = date_text
            elif (nxt[0] or "").startswith("Date: ") and (nxt[1] or "").startswith("Time: ") \
                    and (nxt[2] or "").startswith("Location: "):
                title, date_text, time_text, place = line[7:], nxt[0][6:], nxt[1][6:], nxt[2][10:]
            else:
                continue
            events.append({"title": title, "date": self._date(date_text), "time": self._time(time_text),
                           "location": place, "category": title, "description": ""})
        # a missing time must still be a string in a valid answer: leave it to the
        # defaults stage by sending the key only when known
        for e in events:
            if e["time"] is None:
                e["time"] = X.DEFAULT_TIME
        return json.dumps({"events": events}, ensure_ascii=False)


class UnsteadyExtractor(LineFormatExtractor):
    """A line-format extractor that fails by the first hex digit of the chunk's md5: 0-3 the first
    time it is asked, 4-5 always, 6-7 with an answer that is none. For tests of call control."""

    def __init__(self, default_year: int = X.DEFAULT_YEAR):
        super().__init__(default_year)
        self.asked: set[str] = set()

    def __call__(self, chunk: str) -> str:
        key = hashlib.md5(chunk.encode()).hexdigest()
        again = key in self.asked
        self.asked.add(key)
        if key[0] in "45" or (key[0] in "0123" and not again):
            raise ConnectionError("no answer")
        return '{"events": [{"title": 1}]}' if key[0] in "67" else super().__call__(chunk)
