from hearthline.streaming.gate import gate_events
from hearthline.streaming.pipeline import EventLake, start

__all__ = ["EventLake", "gate_events", "start"]
