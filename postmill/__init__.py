"""Job-posting analytics as Spark jobs: landed pages and logs in, postings, reports and gates out."""

__version__ = "0.1.0"
