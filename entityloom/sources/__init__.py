"""Where rows come from and where entities go."""
