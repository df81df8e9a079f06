"""Fixed values and default parameters.

Everything in the first block must equal the published rules and column contract
for results to agree, so it is stated as plain text and used from here only.
"""

from __future__ import annotations

# --- fixed values: column contract -------------------------------------------------
AI4I_TO_SNAKE = {
    "Type": "type",
    "Air temperature [K]": "air_temperature_kelvin",
    "Process temperature [K]": "process_temperature_kelvin",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_minutes",
    "Machine failure": "machine_failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
    "RNF": "rnf",
}
SENSORS = [
    "air_temperature_kelvin",
    "process_temperature_kelvin",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_minutes",
]
DERIVED = ["power_kw", "temp_diff_kelvin", "mechanical_stress"]
NUMERIC_FEATURES = SENSORS + DERIVED
FEATURES = ["type"] + NUMERIC_FEATURES

# --- fixed values: physics rules (Matzka 2020) --------------------------------------
PI = 3.14159
HDF_MAX_RPM = 1380.0
HDF_MAX_GAP = 8.6
PWF_MIN_WATTS = 3500.0
PWF_MAX_WATTS = 9000.0
OSF_LIMITS = {"L": 11000.0, "M": 12000.0, "H": 13000.0}
OSF_DEFAULT = 11000.0
WEAR_LIMITS = {"L": 200.0, "M": 220.0, "H": 240.0}
WEAR_DEFAULT = 240.0
FLAG_PRIORITY = ["twf", "hdf", "pwf", "osf"]
FAILURE_CLASSES = ["hdf", "none", "osf", "pwf", "twf"]
PRODUCT_BASE = 20000

# --- fixed values: request contract ---------------------------------------------------
MACHINE_TYPE_PATTERN = "^[LMH]$"
# column: (low, low is inclusive, high, high is inclusive)
SENSOR_BOUNDS = {
    "air_temperature_kelvin": (270.0, False, 320.0, False),
    "process_temperature_kelvin": (270.0, False, 320.0, False),
    "rotational_speed_rpm": (0.0, False, 3000.0, False),
    "torque_nm": (0.0, True, 100.0, False),
    "tool_wear_minutes": (0.0, True, 260.0, True),
}

# --- fixed values: scenario ------------------------------------------------------------
BASE_FAILURE_RATE = 0.034
RAMP_PEAK_RATE = 0.25
SPIKE_RATE = 0.40
FAULT_TORQUE_ADD = 18.0
FAULT_RPM_SHIFT = -350.0
FAULT_RPM_FLOOR = 500.0
FAULT_GAP_MEAN = 8.2
HDF_FRACTION = 0.339

# --- fixed values: training and promotion ------------------------------------------------
TRAINING_WINDOW = 50_000
TEST_SHARE = 0.2
SEED = 42
CV_FOLDS = 5
CALIBRATION_FOLDS = 3
OVERFIT_WARNING = 0.10
BINARY_MODEL = "predictive-maintenance-binary"
MULTICLASS_MODEL = "predictive-maintenance-multiclass"
PRODUCTION_ALIAS = "production"
BINARY_F1_FLOOR = 0.85
MULTICLASS_F1_FLOOR = 0.60

# --- fixed values: drift ---------------------------------------------------------------
DRIFT_SHARE_THRESHOLD = 0.33
CURRENT_ROWS = 10_000
MIN_SAMPLE = 30
SMALL_REFERENCE = 1000
FEW_VALUES = 5
P_VALUE_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
WASSERSTEIN_NORM_FLOOR = 0.001

# --- our own parameters ------------------------------------------------------------------
ALERT_HIGH = 0.85
ALERT_LOW = 0.50
HISTOGRAM_BINS = 20
# Rows one range of the prefix-sum helper should hold.
ROWS_PER_RANGE = 100_000
# Ranges made at most beyond one for each shuffle partition.
RANGE_GRID = 1024
