"""Fixed values that results depend on."""

from __future__ import annotations

# Sentiment labels, in display order.
LABELS = ("Positive", "Neutral", "Negative")

# Label thresholds (both inclusive) and the confidence weight.
POSITIVE_THRESHOLD = 0.05
NEGATIVE_THRESHOLD = -0.05
SUBJECTIVITY_WEIGHT = 0.15

# Defaults of a mention whose field is missing or empty.
DEFAULT_BRAND = "Other"
DEFAULT_USER = "community"
DEFAULT_LABEL = "Neutral"

# Scores given to a row that carries only a label.
LABEL_POLARITY = {"Positive": 0.42, "Negative": -0.42, "Neutral": 0.0}
LABEL_SUBJECTIVITY = 0.5
LABEL_CONFIDENCE = 0.72

# Colours of labels, of anything else, and of a polarity's sign.
LABEL_COLOURS = {"Positive": "#27AE60", "Negative": "#E74C3C", "Neutral": "#95A5A6"}
OTHER_COLOUR = "#BDC3C7"
UP_COLOUR = "#27AE60"
DOWN_COLOUR = "#E74C3C"

# Polarity buckets, lowest first. The names are fixed values; the cut-points are ours.
BUCKETS = ("Strongly Negative", "Negative", "Neutral", "Positive", "Strongly Positive")
STRONG_POLARITY = 0.5

# Window detector.
WINDOW_SECONDS = 60
HISTORY_WINDOWS = 30
MIN_BASELINE = 3
MIN_WINDOWS = 4
FLAT_BASELINE_Z = 5.0
ALERT_Z = 2.5
HIGH_Z = 4.0
MIN_SPIKE_VOLUME = 3
MIN_NEGATIVE_RATIO = 0.5

# Isolation forest.
FOREST_MIN_WINDOWS = 8
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_ALERT = 0.08
FOREST_SEED = 31

# Share of negative rows above which an alert is raised.
NEGATIVE_SHARE = 0.30

# Titles and sentences of alerts; the parts stand around the figures.
SPIKE_TITLE = "Tweet volume spike"
SPIKE_REASON = ("Current window has ", " mentions (", " standard deviations above baseline).")
SURGE_TITLE = "Negative sentiment surge"
SURGE_REASON = ("Negative share is ", "% (", " standard deviations above baseline).")
BRAND_TITLE = "Unusual activity · "
BRAND_REASON = (" mentions for ", " landed in one window (", " standard deviations above baseline).")
FOREST_TITLE = "Unusual sentiment pattern"
FOREST_REASON = "Isolation Forest flagged an atypical combination of volume and sentiment metrics."
SHARE_TITLE = "Elevated negative sentiment"
SHARE_REASON = "% of the current stream is negative."
DEMO_TITLE = "Negative sentiment spike - "
DEMO_REASON = "Demo anomaly injected into the local stream for dashboard review."

# Request limits as (limit, seconds), sign-in burst and lock-out.
API_LIMIT = (240, 60)
SIGNUP_LIMIT = (10, 3600)
LOGIN_BURST = (15, 300)
LOCKOUT_FAILURES = 5
LOCKOUT_SECONDS = 900

# Feed, history and report sizes.
PAGE_SIZE = 12
MAX_PAGE_SIZE = 100
HISTORY_ROWS = 5000
BUFFER_ROWS = 5000
BUFFER_TRIM = 1000
REPORT_ROWS = 30
REPORT_CHARS = 300
TOP_WORDS = 20
TOP_BRANDS = 6
AUDIT_CHARS = 2000

# Stream trigger and back-pressure.
TRIGGER = "5 seconds"
MAX_OFFSETS_PER_TRIGGER = 200
WATERMARK = "10 minutes"
