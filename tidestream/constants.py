"""Names and numbers that results depend on; every value here is fixed."""

# Event types and the ones that must name a product.
EVENT_TYPES = ("page_view", "add_to_cart", "purchase", "search")
PRODUCT_EVENT_TYPES = ("page_view", "add_to_cart", "purchase")

# Product categories and device types.
CATEGORIES = ("Electronics", "Clothing", "Footwear", "Home & Garden", "Sports", "Accessories")
DEVICE_TYPES = ("desktop", "mobile", "tablet")

# Topics, the job each one feeds, and when a batch is cut: so many messages or so long.
CLICKSTREAM_TOPIC = "retail_clickstream"
TRANSACTIONS_TOPIC = "retail_transactions"
INVENTORY_TOPIC = "retail_inventory"
TOPIC_JOBS = {
    CLICKSTREAM_TOPIC: "clickstream-processing-job",
    TRANSACTIONS_TOPIC: "transaction-processing-job",
    INVENTORY_TOPIC: "inventory-processing-job",
}
DEFAULT_JOB = "default-processing-job"
BATCH_INTERVAL = "30 seconds"
BATCH_MESSAGES = 100
POLL_INTERVAL = "1 second"

# Dashboard thresholds as (yellow from, green from).
CONVERSION_LEVELS = (2, 5)
ACTIVE_USER_LEVELS = (100, 500)
REVENUE_LEVELS = (1000, 5000)

# Upper bounds (exclusive) and labels of the probability buckets.
PROBABILITY_BUCKETS = ((0.2, "0-20%"), (0.4, "20-40%"), (0.6, "40-60%"), (0.8, "60-80%"))
TOP_BUCKET = "80-100%"
RETARGET_ABOVE = 0.80
RETARGET_ROWS = 20
DRIFT_ABOVE = 0.05

# Model name, split and training settings.
MODEL_NAME = "purchase_propensity_model"
SEED = 42
TRAIN_PERCENT = 80
LOGISTIC_SETTINGS = {
    "maxIter": 100,
    "regParam": 0.1,
    "elasticNetParam": 0.5,
    "family": "binomial",
}
BOOSTING_SETTINGS = {
    "maxIter": 50,
    "maxDepth": 5,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "seed": SEED,
}
