"""Keyed state machines for ``transformWithStateInPandas``.

Each factory builds its processor class locally, so it travels to the workers by value. Rows of one key inside a
micro-batch are put in ``seq`` order first; the size of a micro-batch is set at the source (files or offsets per trigger),
which is also what bounds the rows of a hot key held at once. Files must come in the order of ``seq``; input that does not is refused with
an error, never folded in the wrong order. State has no time to live: history is never pruned.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def in_order(rows: Iterator[pd.DataFrame], last: int | None, key: tuple) -> pd.DataFrame:
    """A key's rows of a micro-batch by ``seq``; a row at or before one that an earlier micro-batch has folded stops the stream."""
    batch = pd.concat(rows).sort_values("seq")
    if last is not None and int(batch["seq"].iloc[0]) <= last:
        raise ValueError(f"seq {int(batch['seq'].iloc[0])} of {key} came after {last} was folded: give the files in the order of seq")
    return batch


def event_state() -> tuple[StatefulProcessor, str]:
    """Event upserts per (source, event_key): input seq, payload; output one outcome and the merged event per row."""

    ordered = in_order

    class EventState(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.event = handle.getValueState("event", "fields string, last bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            import json
            known, last = self.event.get() if self.event.exists() else ("{}", None)
            fields, out = json.loads(known), []
            batch = ordered(rows, last, key)
            for seq, payload in zip(batch["seq"], batch["payload"]):
                event = json.loads(payload)
                fixed = fields.get("status") == "emitted"
                legal = not fixed or (event.get("status") == "emitted" and event.get("cycle_id") == fields.get("cycle_id"))
                if legal:
                    fields.update(event)
                out.append((seq, "accepted" if legal else "rejected", json.dumps(fields, sort_keys=True)))
            self.event.update((json.dumps(fields, sort_keys=True), int(batch["seq"].iloc[-1])))
            frame = pd.DataFrame(out, columns=["seq", "outcome", "event"])
            frame.insert(0, "source", key[0])
            frame.insert(1, "event_key", key[1])
            yield frame

        def close(self) -> None:
            pass

    return EventState(), "source string, event_key string, seq bigint, outcome string, event string"


def deliveries() -> tuple[StatefulProcessor, str]:
    """Delivery attempts per (cycle_id, channel): input seq, action, evidence_ok."""

    ordered = in_order

    class Deliveries(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.current = handle.getValueState("current", "state string, attempt bigint, last bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            state, attempt, last = self.current.get() if self.current.exists() else ("none", 0, None)
            out, batch = [], ordered(rows, last, key)
            for seq, action, proven in zip(batch["seq"], batch["action"], batch["evidence_ok"]):
                idle = state in ("none", "failed")
                if action == "start":
                    outcome = "started" if idle else "blocked"
                    if idle:
                        state, attempt = "pending", attempt + 1
                elif state == "none":
                    outcome = "no_intent"
                elif state in ("failed", "confirmed"):
                    outcome = "terminal"
                elif action != "unknown" and not proven:
                    outcome = "refused"
                else:
                    outcome = state = action
                out.append((seq, outcome, attempt))
            self.current.update((state, int(attempt), int(batch["seq"].iloc[-1])))
            frame = pd.DataFrame(out, columns=["seq", "outcome", "attempt"])
            frame.insert(1, "cycle_id", key[0])
            frame.insert(2, "channel", key[1])
            yield frame

        def close(self) -> None:
            pass

    return Deliveries(), "seq bigint, cycle_id string, channel string, outcome string, attempt bigint"


def emissions() -> tuple[StatefulProcessor, str]:
    """First emission per (source, event_key) over all history: input seq of emitted rows."""

    class Emissions(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.emitted = handle.getValueState("emitted", "seq bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            first = min(int(batch["seq"].min()) for batch in rows)
            if self.emitted.exists():
                if first <= self.emitted.get()[0]:
                    raise ValueError(f"seq {first} of {key} came after {self.emitted.get()[0]} was emitted: give the files in the order of seq")
            else:
                self.emitted.update((first,))
                yield pd.DataFrame({"source": [key[0]], "event_key": [key[1]], "seq": [first]})

        def close(self) -> None:
            pass

    return Emissions(), "source string, event_key string, seq bigint"
