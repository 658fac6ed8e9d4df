"""Defaults and names shared across operators.

Fixed values: these must equal the reference's for results, reports and
outputs to match. They are listed together, in plain text, in natural order.
"""

# --- Fixed values -----------------------------------------------------------

# file integrity status strings
STATUS_VALID = "VALID"
STATUS_CORRUPT = "CORRUPT (0 Bytes)"

# phrase-driver segment names by label
SEGMENT_POSITIVE = "Positive_Drivers"
SEGMENT_NEGATIVE = "Negative_Drivers"

# surrogate row-number column dropped on read
SURROGATE_COLUMN = "Serial No."

# output columns of the four scorers
OUT_PROBABILITY_OF_DEFAULT = "Probability of Default"
OUT_PREDICTED_SENTIMENT = "Predicted_Sentiment"
OUT_CONFIDENCE_SCORE = "Confidence_Score"
OUT_PREDICTED_ADMIT = "Predicted Chance of Admit"
OUT_PREDICTED_STATUS = "Predicted Status"
OUT_PREDICTION_CONFIDENCE = "Prediction Confidence"

# scored-CSV float format
FLOAT_FORMAT = "%.8f"

# default knobs of the reference modules
SEED = 42
TEST_RATIO = 0.2
ALPHA = 1e-4                 # L2 strength of the linear learners
ETA0 = 0.01                  # SGD learning rate
PA_C = 1.0                   # Passive-Aggressive aggressiveness
N_MEMBERS = 7                # soft-voting ensemble size
N_COMPONENTS = 1200          # Nystroem basis size
RBF_GAMMA = 0.1              # Nystroem kernel width
N_HASH_FEATURES = 2 ** 20    # hashed bag-of-words width
BLOOM_N_ITEMS = 10_000_000   # Bloom filter design size
BLOOM_P = 0.01               # Bloom filter false-positive rate
TOP_PHRASES = 20             # phrase drivers per segment
TOP_ALERTS = 200             # priority alerts kept
DECISION_CUT = 0.5           # probability decision (>=)
