from .flows import read_flows, resolve_source, stage_flows, write_metrics
from .mock import mock_flows
from .packets import read_packets
from .store import load_json, load_table, save_json, save_table

__all__ = ["load_json", "load_table", "mock_flows", "read_flows", "read_packets", "resolve_source", "save_json",
           "save_table", "stage_flows", "write_metrics"]
