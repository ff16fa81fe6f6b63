"""Streaming: fitted preparation and models applied to streaming frames."""
