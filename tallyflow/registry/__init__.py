from tallyflow.registry import aggregates, reports, scans, stateful, stores
from tallyflow.registry.base import Entry

ALL: dict[str, Entry] = {**scans.REGISTRY, **aggregates.REGISTRY, **reports.REGISTRY, **stores.REGISTRY, **stateful.REGISTRY}
