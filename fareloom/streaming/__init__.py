from fareloom.streaming.alerts import threshold_alerts
from fareloom.streaming.runner import run_append, run_complete, run_parts, show_forever

__all__ = ["run_append", "run_complete", "run_parts", "show_forever", "threshold_alerts"]
