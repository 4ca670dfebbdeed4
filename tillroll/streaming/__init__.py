from tillroll.streaming.ingest import start_ingest, stream_table

__all__ = ["start_ingest", "stream_table"]
