"""ebbtide: churn, retention and customer-value analytics as Spark jobs."""
