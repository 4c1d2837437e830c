"""Every threshold, width and expectation of the monitor, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# The channel names a complete recording window carries.
EXPECTED_CHANNELS = (
    "FP1-F7",
    "F7-T7",
    "T7-P7",
    "P7-O1",
    "FP1-F3",
    "F3-C3",
    "C3-P3",
    "P3-O1",
    "FP2-F4",
    "F4-C4",
    "C4-P4",
    "P4-O2",
    "FP2-F8",
    "F8-T8",
    "T8-P8-0",
    "P8-O2",
    "FZ-CZ",
    "CZ-PZ",
    "P7-T7",
    "T7-FT9",
    "FT9-FT10",
    "FT10-T8",
    "T8-P8-1",
)

# The two labels an alert can carry.
SPIKE_REASON = "spike_threshold"
VARIANCE_REASON = "high_variance"


@dataclass(frozen=True)
class MonitorParams:
    """Settings shared by batch, stream and quality jobs. Voltages are in volts.

    ``cell_seconds`` is the time grid of the interval joins: pick it near the length of a typical
    labelled interval, and no shorter than a feature window. ``block_seconds`` is the stretch of one
    series that is ordered by a single task in the windowed operators.
    """

    window: str = "5 seconds"
    watermark: str = "3 seconds"
    spike_volts: float = 5e-5
    spike_limit: int = 10
    variance_limit: float = 5e-5
    sampling_rate: float = 256
    volts_limit: float = 500
    channels: tuple[str, ...] = EXPECTED_CHANNELS
    rows_per_window: int = len(EXPECTED_CHANNELS)
    channel_count_keys: tuple[str, ...] = ("window_start",)
    patient_pattern: str = r"^chb\d{2}$"
    pad_seconds: int = 30
    cell_seconds: int = 300
    block_seconds: int = 6 * 3600
