"""Objects behind an API that gives each a version and takes a new one only from those who have read the last."""

from __future__ import annotations

import base64
import json
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators import briefings
from harrow.sources.readers import briefing_items

#: Answers that say that somebody else has written meanwhile.
CONFLICTS = (409, 412, 422)


class Conflict(RuntimeError):
    """The object has another version than the one that was read."""


@dataclass
class Versioned:
    """An object: its url, the branch that it is on, and the token to use."""

    url: str
    token: str
    branch: str = "main"
    timeout: float = 30.0

    def ask(self, url: str, method: str = "GET", payload: dict | None = None) -> dict | None:
        """The JSON answer; None where there is no such object."""
        headers = {"Accept": "application/json", "Authorization": f"Bearer {self.token}", "Content-Type": "application/json"}
        request = urllib.request.Request(url, data=None if payload is None else json.dumps(payload).encode(), method=method, headers=headers)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                return json.loads(response.read())
        except urllib.error.HTTPError as e:
            if e.code == 404 and method == "GET":
                return None
            said = e.read().decode(errors="replace")[:300]
            raise (Conflict if e.code in CONFLICTS else RuntimeError)(f"{method} failed with {e.code}: {said}") from e

    def read(self) -> tuple[str | None, str | None]:
        """The object's text and version; neither where there is none yet."""
        found = self.ask(f"{self.url}?{urllib.parse.urlencode({'ref': self.branch})}")
        return (None, None) if found is None else (base64.b64decode(found.get("content", "")).decode(), found.get("sha"))

    def write(self, text: str, version: str | None, message: str) -> None:
        """Puts a new text in place of the version that was read, or of none; a Conflict if there is another by now."""
        update = {"message": message, "content": base64.b64encode(text.encode()).decode(), "branch": self.branch}
        self.ask(self.url, "PUT", update | ({"sha": version} if version else {}))


def publish_briefings(spark: SparkSession, new: DataFrame, target: Versioned, updated_at: str, *, most: int = 60, attempts: int = 3) -> int:
    """Puts briefings (as ``briefings.normalize`` takes them) into the published document, in place of those of their
    dates; gives how many it holds then.  Where somebody else has written meanwhile, their document is read and the
    briefings are put into that.  The document holds ``most`` briefings, so it is made here."""
    rows = briefings.normalize(new, required=True)
    named = rows.withColumnRenamed("market_tone", "marketTone")
    for left in range(attempts - 1, -1, -1):
        text, version = target.read()
        stored = briefing_items(spark.createDataFrame([(text or '{"items": []}',)], "value string"))
        kept = briefings.normalize(stored).withColumnRenamed("market_tone", "marketTone")
        items = [json.loads(r[0]) for r in briefings.publish(kept, named, most).select(F.to_json(F.struct(*named.columns))).collect()]
        document = json.dumps({"updatedAt": updated_at, "items": items}, ensure_ascii=False, indent=2) + "\n"
        try:
            target.write(document, version, f"data: publish briefings up to {items[0]['date'] if items else '-'}")
            return len(items)
        except Conflict:
            if not left:
                raise
    raise ValueError("no attempts")
