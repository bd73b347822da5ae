from tallyweave.streaming.intake import intake_files
from tallyweave.streaming.upsert import upsert, upsert_files

__all__ = ["intake_files", "upsert", "upsert_files"]
