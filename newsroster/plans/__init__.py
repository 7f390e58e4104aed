"""The three jobs: collect, process, publish. Process and publish run Spark jobs of their own to pin or write tables."""
