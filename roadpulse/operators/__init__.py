"""DataFrame operators on detections, trips, stations and landing records."""
