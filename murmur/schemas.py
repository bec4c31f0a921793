"""Schemas of messages, mentions, alerts and audit rows."""

from __future__ import annotations

# Column names and types of messages, files and tables.
MESSAGE = "tweet_id INT, tweet_text STRING, produced_at STRING, brand STRING, username STRING"
RAW_COLUMNS = ("tweet_id", "entity", "sentiment_label", "tweet_text")
MENTION_COLUMNS = ("timestamp", "tweet", "brand", "username", "sentiment",
                   "polarity", "subjectivity", "confidence")
SCORED = ("timestamp STRING, tweet STRING, brand STRING, username STRING, clean_tweet STRING, "
          "polarity DOUBLE, subjectivity DOUBLE, sentiment STRING, confidence DOUBLE")
ENRICHED = ("timestamp TIMESTAMP, tweet STRING, clean_tweet STRING, polarity DOUBLE, "
            "subjectivity DOUBLE, sentiment STRING, confidence DOUBLE, brand STRING, "
            "polarity_bucket STRING")
HISTORY = ("tweet_hash STRING, timestamp TIMESTAMP, tweet STRING, brand STRING, username STRING, "
           "sentiment STRING, polarity DOUBLE, subjectivity DOUBLE, confidence DOUBLE, day DATE")
ALERT_LOG = ("alert_id STRING, title STRING, detail STRING, severity STRING, status STRING, "
             "at TIMESTAMP")
ALERTS = ("alert_id STRING, title STRING, detail STRING, severity STRING, status STRING, "
          "created_at TIMESTAMP, updated_at TIMESTAMP")
WINDOW_FACTS = "window_start TIMESTAMP, brand STRING, mentions BIGINT, negatives BIGINT, polarity_micro BIGINT, batch_id BIGINT"
LATE_ROWS = "run STRING, batch_id BIGINT, late BIGINT"
STATUS_LOG = "alert_id STRING, status STRING, at TIMESTAMP"
AUDIT = "id BIGINT, user_id STRING, event STRING, detail STRING, created_at TIMESTAMP"
